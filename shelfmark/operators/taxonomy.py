"""Classification of texts by a table of keywords, of any size.

The rows of the table are compiled into an automaton that finds every keyword in one reading of a text, however many
there are. What a text holds is then decided with array functions, by the rule of each kind.

A taxonomy is `(kind, rule, label, label_order, keyword, keyword_order)`. A kind's rule is `first` (the label that
comes first in order, with its first keyword in list order) or `most` (the label with most distinct keywords, the
earlier one on a tie).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keywords of one automaton, which every task holds; a longer table is read in blocks, with a pass over the texts each.
BLOCK = 200_000
HIT = "struct<kind:string,rule:string,label:string,label_order:int,keyword:string,keyword_order:int>"
# Four letters outside ASCII that match an ASCII letter when case is ignored.
ALIKE = str.maketrans({"ſ": "s", "ı": "i", "İ": "i", "K": "k"})


def taxonomy_table(spark: SparkSession, kinds: Mapping[str, tuple[str, Mapping[str, Sequence[str]]]]) -> DataFrame:
    """The table of taxonomies given as {kind: (rule, {label: keywords})}."""
    rows = [
        (kind, rule, label, i, keyword, j)
        for kind, (rule, labels) in kinds.items()
        for i, (label, keywords) in enumerate(labels.items())
        for j, keyword in enumerate(keywords)
    ]
    kind = "kind string, rule string, label string, label_order int, keyword string, keyword_order int"
    return spark.createDataFrame(rows, kind)


def folded(text: str) -> str:
    """Text as it is compared: case ignored, one character for one."""
    if text.isascii():
        return text.lower()
    low = text.translate(ALIKE).lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text.translate(ALIKE))


def _word(c: str) -> bool:
    return c.isalnum() or c == "_"


def _hits(rows: DataFrame, block: list[tuple], key: str) -> DataFrame:
    """(key, hits) of rows (key, text): the distinct keywords of the block in each text, as whole words."""
    by_keyword: dict[str, list[dict]] = {}
    for kind, rule, label, label_order, keyword, keyword_order in block:
        entry = {"kind": kind, "rule": rule, "label": label, "label_order": label_order, "keyword": keyword, "keyword_order": keyword_order}
        by_keyword.setdefault(folded(keyword), []).append(entry)
    by_keyword.pop("", None)
    words = list(by_keyword)
    shared = rows.sparkSession.sparkContext.broadcast(words)
    hit = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        machine = ahocorasick.Automaton()
        for n, word in enumerate(shared.value):
            machine.add_word(word, (n, len(word)))
        if len(machine):
            machine.make_automaton()

        def found(text: str | None) -> list[int]:
            text = folded(text or "")
            seen: set[int] = set()
            for end, (n, size) in machine.iter(text) if len(machine) and text else ():
                if n not in seen:
                    at = end + 1 - size
                    before, after = text[at - 1 : at] if at else "", text[end + 1 : end + 2]
                    bounded = (bool(before) and _word(before)) != _word(text[at]) and (bool(after) and _word(after)) != _word(text[end])
                    if bounded:
                        seen.add(n)
            return sorted(seen)

        for batch in batches:
            hits = [found(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(hits, hit)], [key, "hits"])

    kind = rows.schema[key].dataType.simpleString()
    numbered = rows.mapInArrow(run, f"{key} {kind}, hits array<int>")
    entries = [(n, by_keyword[w]) for n, w in enumerate(words)]
    table = rows.sparkSession.createDataFrame(entries, f"n int, entries array<{HIT}>")
    # Back from numbers to rows of the table: a hit is a number, a join puts its entries beside it.
    listed = numbered.select(key, F.explode("hits").alias("n")).join(F.broadcast(table), "n")
    return listed.select(key, F.explode("entries").alias("hit"))


def taxonomy_hits(df: DataFrame, taxonomy: DataFrame, key: str, col: str = "content") -> DataFrame:
    """`(key, hit)`: every keyword of the table that a text holds as a whole word, once, with its labels.

    Word boundaries are those of Unicode letters, digits and underscores, case is ignored. Keys are unique. The driver
    reads the table in blocks of BLOCK rows, which bounds what it and each task hold; every block is one pass over the texts.
    """
    rows = df.select(key, F.col(col).alias("text"))
    named = taxonomy.where(F.length("keyword") > 0).select("kind", "rule", "label", "label_order", "keyword", "keyword_order").distinct()
    blocks = max(1, -(-named.count() // BLOCK))
    out = None
    for b in range(blocks):
        # Equal keywords are in one block, so a text names each once.
        mine = named.where(F.pmod(F.xxhash64(F.lower("keyword")), F.lit(blocks)) == b) if blocks > 1 else named
        found = _hits(rows, [tuple(r) for r in mine.collect()], key)
        out = found if out is None else out.unionByName(found)
    return out


def classify_by_table(df: DataFrame, taxonomy: DataFrame, key: str, col: str = "content") -> DataFrame:
    """`(key, kind, label, keyword, n)`: what each text is by each kind of the table that has a hit in it.

    `keyword` is the first one in list order of the chosen label, `n` its number of distinct keywords.
    """
    hits = taxonomy_hits(df, taxonomy, key, col).select(key, "hit.*")
    first = F.min(F.struct("keyword_order", "keyword")).alias("first")
    by_label = hits.groupBy(key, "kind", "rule", "label", "label_order").agg(F.count_distinct("keyword").alias("n"), first)
    rank = F.struct(F.when(F.col("rule") == "most", -F.col("n")).otherwise(0).alias("n"), "label_order", "label")
    chosen = F.min_by(F.struct("label", F.col("first.keyword").alias("keyword"), "n"), rank)
    return by_label.groupBy(key, "kind").agg(chosen.alias("_c")).select(key, "kind", "_c.*")
