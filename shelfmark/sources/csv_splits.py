"""Records of CSV files that are read in splits, though quoted values may hold line ends.

Whether a line begins inside quotes depends on all lines before it. Each split is therefore
taken as a map of two states, outside and inside quotes, from its begin to its end. A running
product of these maps over the splits of a file tells how each one begins, and then
every split finds its records by itself. Only records that cross a border are put together.

Lines end with LF or CRLF; a lone CR ends no line here.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Splits whose first states are broadcast at once; files with more in all are read in turns.
SPLITS = 200_000
BLANK = r"(?s)^[,\s]*$"
_PLACES = "file string, start long"


def ends_inside(line: str, inside: bool) -> bool:
    """Whether the end of a line lies in quotes. A quote opens a value only where the value begins."""
    at = 0
    if not inside and line.startswith('"'):
        inside, at = True, 1
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('""', at):
                at += 2
                continue
            inside = False
            at += 1
        at = line.find(',"', at)
        if at < 0:
            return False
        inside, at = True, at + 2


def lines(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """`(file, start, whole, value)`: all lines, with the split they are read in, and whether it is the whole file."""
    reader = spark.read.option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    m = "_metadata"
    return reader.text(paths if isinstance(paths, str) else list(paths)).select(
        F.col(f"{m}.file_path").alias("file"),
        F.col(f"{m}.file_block_start").alias("start"),
        (F.col(f"{m}.file_block_length") >= F.col(f"{m}.file_size")).alias("whole"),
        "value",
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch, bool]]:
    """The lines of each split in turn, as parts of batches: (file, start), the part, whether it is the split's first."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        files, begins = batch.column("file").to_pylist(), batch.column("start").to_pylist()
        lo = 0
        for i in range(1, batch.num_rows + 1):
            if i == batch.num_rows or begins[i] != begins[lo] or files[i] != files[lo]:
                key = files[lo], begins[lo]
                yield key, batch.slice(lo, i - lo), key != last
                last, lo = key, i


def split_maps(rows: DataFrame) -> DataFrame:
    """`(file, start, from_outside, from_inside)`: the state at the end of each split, by the state at its begin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ends, done = None, None, []
        for place, part, first in _runs(batches):
            if first:
                if key:
                    done.append((*key, *ends))
                key, ends = place, [False, True]
            quoted = part.filter(pc.match_substring(part.column("value"), '"'))
            for line in quoted.column("value").to_pylist():
                ends = [ends_inside(line, s) for s in ends] if ends[0] != ends[1] else [ends_inside(line, ends[0])] * 2
        if key:
            done.append((*key, *ends))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["file", "start", "from_outside", "from_inside"])

    return rows.mapInArrow(run, f"{_PLACES}, from_outside boolean, from_inside boolean")


def first_states(maps: DataFrame) -> DataFrame:
    """`(file, start, inside, ends_inside)`: the state at the begin and the end of each split.

    The product of two-state maps up to a split is that of the last constant one, or outside
    without one, turned over by every map since that exchanges the states.
    """
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    constant = F.col("from_outside") == F.col("from_inside")
    exchange = (F.col("from_outside") & ~F.col("from_inside")).cast("int")
    turned = maps.withColumn("_turns", F.sum(exchange).over(upto))
    # What the last constant map leaves, as if no state had been exchanged before it.
    base = F.when(constant, (F.col("from_outside").cast("int") + F.col("_turns")) % 2)
    turns_before = F.coalesce(F.sum(exchange).over(before), F.lit(0))
    held = F.coalesce(F.last(base, ignorenulls=True).over(before), F.lit(0))
    state = turned.withColumn("inside", (held + turns_before) % 2 == 1)
    ends = F.when(F.col("inside"), F.col("from_inside")).otherwise(F.col("from_outside"))
    return state.select("file", "start", "inside", ends.alias("ends_inside"))


def _cut(rows: DataFrame, crossing: bool, last: bool = False) -> DataFrame:
    """`(file, start, nth, part, text)`: the records of each split, or the parts of records that cross its borders.

    `rows` are lines with the state `inside` of their split. Records are numbered from 0 by the split
    they begin in, empty lines left out. Part 1 begins a record, 0 goes on with one from before.
    Where no split follows (`last`), quotes left open end with the file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nth, head, open_lines = None, 0, False, None
        done: list[tuple] = []

        def close() -> None:  # at the end of a split
            if (crossing or last) and open_lines:
                done.append((*key, nth, 0 if head else 1, "\n".join(open_lines)))

        def out() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], ["file", "start", "nth", "part", "text"])
            done.clear()
            return made

        for place, part, first in _runs(batches):
            if first:
                if key:
                    close()
                key, nth = place, 0
                head = part.column("inside")[0].as_py()
                open_lines = [] if head else None
            quoted = pc.match_substring(part.column("value"), '"').to_pylist()
            for line, marks in zip(part.column("value").to_pylist(), quoted):
                if open_lines is not None:
                    open_lines.append(line)
                    if marks and not ends_inside(line, True):
                        if crossing and head:
                            done.append((*key, 0, 0, "\n".join(open_lines)))
                        elif not head:
                            if not crossing:
                                done.append((*key, nth, 1, "\n".join(open_lines)))
                            nth += 1
                        head, open_lines = False, None
                elif marks and ends_inside(line, False):
                    open_lines = [line]
                elif line not in ("", "\r"):
                    if not crossing:
                        done.append((*key, nth, 1, line))
                    nth += 1
            if len(done) >= 10_000:
                yield out()
        if key:
            close()
        if done:
            yield out()

    return rows.select("file", "start", "inside", "value").mapInArrow(run, f"{_PLACES}, nth long, part int, text string")


def _assembled(parts: DataFrame) -> DataFrame:
    """Records out of their parts; of a split, what goes on comes before what begins."""
    order = Window.partitionBy("file").orderBy("start", "part").rowsBetween(Window.unboundedPreceding, 0)
    numbered = parts.withColumn("_record", F.sum("part").over(order))
    texts = F.array_sort(F.collect_list(F.struct("start", "nth", "text")))
    whole = numbered.groupBy("file", "_record").agg(texts.alias("_texts"))
    first = F.col("_texts")[0]
    return whole.select("file", first["start"].alias("start"), first["nth"].alias("nth"), F.array_join("_texts.text", "\n").alias("text"))


def records(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None, among: DataFrame | None = None) -> DataFrame:
    """`(file, start, nth, text)`: all records of CSV files, headers too, with the split and the place they begin at.

    Only files `among` a few (a column file) where given. Files of one split are read once. Larger ones are read once
    more for the maps of their splits, and splits that begin or end within a record once more for the parts of these.
    """
    rows = lines(spark, paths, glob)
    if among is not None:
        rows = _found(rows, among, ["file"], "left_semi")
    name = ["file", "start", "nth", "text"]
    out = _cut(rows.where("whole").withColumn("inside", F.lit(False)), False, True).select(*name)
    split = rows.where("NOT whole")
    states = first_states(split_maps(split))
    for mine in _turns(states.count()):
        known = states.where(mine)
        out = out.unionByName(_cut(_found(split, known, ["file", "start"]), False).select(*name))
        open_ones = known.where("inside OR ends_inside")
        out = out.unionByName(_assembled(_cut(_found(split, open_ones, ["file", "start"]), True)))
    return _tidy(out)


def _found(rows: DataFrame, known: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """`rows` joined with `known`, which is broadcast, on columns of these names.

    The join alone picks the files of a turn. Were its keys plain columns, the condition on `file` would be inferred
    for `rows` and used on listed files, whose paths are written in another way; so the keys are structs.
    """
    few = known.select(F.struct(*names).alias("_at"), *[c for c in known.columns if c not in names])
    return rows.join(F.broadcast(few), F.struct(*[rows[n] for n in names]) == F.col("_at"), how).drop("_at")


def _turns(n: int) -> list[Column]:
    """Conditions on `file` that part n rows of files into turns of about SPLITS rows."""
    turns = -(-n // SPLITS)
    return [F.pmod(F.xxhash64("file"), F.lit(turns)) == t for t in range(turns)] if turns > 1 else [F.lit(True)] * turns


def _tidy(found: DataFrame) -> DataFrame:
    """Without the CR of a CRLF at the end of a record, and the mark that some files begin with."""
    text = F.regexp_replace("text", "\r$", "")
    text = F.when((F.col("start") == 0) & (F.col("nth") == 0), F.regexp_replace(text, "^﻿", "")).otherwise(text)
    return found.withColumn("text", text).where("text != ''")


def header_records(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """`(file, start, nth, text, late)`: the first record of each file that is more than commas and white space.

    `late` tells that records of nothing but those stand before it. Read from the first split of
    each file; only files whose first split does not hold the header whole are read further.
    """
    rows = lines(spark, paths, glob).where("start = 0")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        done: list[tuple] = []

        def close() -> None:
            if state and not state["found"]:
                rest = state["open"]
                done.append((state["file"], state["nth"], "\n".join(rest) if rest else "", state["whole"]))

        for (file, _), part, first in _runs(batches):
            if first:
                close()
                state = {"file": file, "found": False, "open": None, "nth": 0, "whole": part.column("whole")[0].as_py()}
            if state["found"]:
                continue
            for line in part.column("value").to_pylist():
                if state["nth"] == 0 and state["open"] is None:
                    line = line.removeprefix("﻿")
                if state["open"] is not None:
                    state["open"].append(line)
                    if ends_inside(line, True):
                        continue
                    line, state["open"] = "\n".join(state["open"]), None
                elif ends_inside(line, False):
                    state["open"] = [line]
                    continue
                if line in ("", "\r"):
                    continue
                if line.strip(", \t\r\n\x0b\x0c"):
                    state["found"] = True
                    done.append((file, state["nth"], line, True))
                    break
                state["nth"] += 1
        close()
        if done:
            kinds = (pa.string(), pa.int64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], ["file", "nth", "text", "whole"])

    found = rows.mapInArrow(run, "file string, nth long, text string, whole boolean")
    text = F.regexp_replace("text", "\r$", "")
    near = found.where(F.col("whole") & ~text.rlike(BLANK)).select("file", F.lit(0).cast("long").alias("start"), "nth", text.alias("text"), (F.col("nth") > 0).alias("late"))
    rest = found.where("NOT whole").select("file")
    out = near
    for mine in _turns(rest.count()):
        far = records(spark, paths, glob, rest.where(mine)).where(~F.col("text").rlike(BLANK))
        far = far.groupBy("file").agg(F.min_by(F.struct("start", "nth", "text"), F.struct("start", "nth")).alias("_first"))
        late = (F.col("_first.start") > 0) | (F.col("_first.nth") > 0)
        out = out.unionByName(far.select("file", "_first.start", "_first.nth", "_first.text", late.alias("late")))
    return out
