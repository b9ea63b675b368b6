"""Best-fit packing of documents into sequences of a fixed number of tokens.

Best-fit-decreasing on the histogram of lengths, in place of bulk-synchronous supersteps:
pieces of one length, and open sequences of one gap, are alike, so the driver
matches ranges (first rank, count) of them, one length after the other, the longest first.
Each goes to the smallest gap that holds it, any number of documents at once; what
found none opens new sequences. No ranges ask at once, so no conflicts arise.

At most `capacity` - 1 lengths are open. Each opens sequences once, as what it opens holds
all that is left of it, and splits a range once, when it runs out: there are never more than
twice as many ranges as lengths, and a range gets at most `capacity` runs, each a piece
for each of its sequences. So there are at most 2 * capacity ** 2 runs, whatever the input is.

The rows themselves never leave Spark: they get their rank within their length by a
count per partition and a running sum, and a join on length and rank blocks gives each
its sequence.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfmark.llm.common import slices, stored
from shelfmark.llm.token_counts import PATTERN, byte_letters

#: A placement: pieces `first`.. of `length` lie at `offset` of sequences `sequence`.., `count` of them.
PLACED = "length int, first long, count long, sequence long, offset int"
#: A run of 2 * BLANK white-space characters has a whole block of BLANK, and so goes to the tokenizer
#: library. Shorter ones are far from where the other library fails (500,000 pass, 1,000,000 do not).
BLANK = 50_000


class TextIds:
    """Token ids of whole texts, as the tokenizer library gives them for a vocabulary file.

    Merging by rank runs in a second public library that is told the same vocabulary,
    which takes a fifth of the time. It knows no special strings, so texts with one go
    to the tokenizer library itself; so do all, if ids are not in the order of merges.
    So do texts with a long run of white space: the other library's regex engine keeps
    a state for each character of such a run, and ends where it has too many.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        letters = byte_letters()
        specials = {i for i, t in self.library.get_added_tokens_decoder().items() if t.special}
        ranks = {bytes(letters[c] for c in t): i for t, i in self.library.get_vocab().items() if i not in specials}
        self.specials = [self.library.id_to_token(i) for i in specials]
        with open(path, encoding="utf-8") as f:
            pairs = json.load(f)["model"]["merges"]
        made = [self.library.token_to_id("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in pairs]
        self.fast = None
        if made == sorted(made):
            self.fast = tiktoken.Encoding("same", pat_str=PATTERN.pattern, mergeable_ranks=ranks, special_tokens={})

    def of(self, text: str) -> np.ndarray:
        blank = any(text[i : i + BLANK].isspace() for i in range(0, len(text) - BLANK + 1, BLANK))
        if self.fast is None or blank or any(s in text for s in self.specials):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.fast.encode_ordinary(text), np.uint32)


@lru_cache(maxsize=2)
def text_ids(path: str) -> TextIds:
    return TextIds(path)


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: the first takes what does not fill a sequence."""
    first = length % capacity or min(capacity, length)
    starts = [0, *range(first, length, capacity)]
    return list(zip(starts, np.diff([*starts, length]).tolist())) if length else []


def pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(id, piece, start, length, ids_crc32): documents as token ids with an end, cut where longer than `capacity`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end = text_ids(vocabulary), np.array([end_id], np.uint32)
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                for doc, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                    ids = np.concatenate([known.of(text or ""), end]).astype("<u4")
                    out += [(doc, k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(cut(len(ids), capacity))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out), [part.schema.field("id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64()])],
                    ["id", "piece", "start", "length", "ids_crc32"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    lean = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return lean.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Place counts[length] pieces of each length: rows of PLACED, one length after the other.

    An open gap range is (first sequence, count). The size of all of this follows from the
    number of different lengths, not from the number of pieces.
    """
    left = {n: c for n, c in counts.items() if c and n <= capacity}
    rank = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []
    placed, opened = [], 0

    def open_gap(size: int, first: int, count: int) -> None:
        if size:
            if size not in gaps:
                gaps[size] = []
                insort(sizes, size)
            gaps[size].append((first, count))

    def place(length: int, first: int, count: int, gap: int) -> None:
        placed.append((length, rank[length], count, first, capacity - gap))
        rank[length] += count
        left[length] -= count
        open_gap(gap - length, first, count)

    def served(gap: int, length: int) -> None:
        """Give sequences of this gap to pieces of this length, as many as there are of both."""
        ranges = gaps.pop(gap)
        sizes.remove(gap)
        while ranges and left[length]:
            first, count = ranges.pop()
            used = min(count, left[length])
            if used < count:
                ranges.append((first + used, count - used))
            place(length, first, used, gap)
        for first, count in ranges:
            open_gap(gap, first, count)

    for length in sorted(left, reverse=True):  # longest first
        while left[length]:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                served(sizes[at], length)
            else:
                fresh = -(-left[length] // (capacity // length))
                place(length, opened, fresh, capacity)
                opened += fresh
    return placed


def with_rank(rows: DataFrame, key: str) -> DataFrame:
    """`rows` with rank: 0, 1, ... within equal `key`, though one key may have most rows.

    Column _p is the stored number of the partition that made a row: ranks inside it are
    sorted there, and what other partitions have before comes from a table of counts, one
    row per key and partition.
    """
    counts = rows.groupBy(key, "_p").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(key).alias("_k"), F.col("_p").alias("_q"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy(key, "_p").orderBy("id", "piece", "ids_crc32")
    ranked = rows.withColumn("_in", F.row_number().over(inside) - 1)
    joined = ranked.join(starts, (F.col(key) == F.col("_k")) & (F.col("_p") == F.col("_q")))
    return joined.withColumn("rank", F.col("_in") + F.col("_before")).drop("_p", "_q", "_k", "_in", "_before")


def pack(
    docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pack documents: (id, piece, start, length, ids_crc32, sequence_id, offset), a row per piece.

    A document is its token ids and `end_id`; only one longer than `capacity` is cut.
    Null and empty texts are the end alone. Repeated rows and null ids are packed each
    for itself; an empty table gives an empty one; other columns are dropped first.
    Pieces that fill a sequence alone are numbered in their own partition and never moved.
    """
    spark = docs.sparkSession
    all_pieces = stored(pieces(docs, vocabulary, capacity, end_id, id_col, text_col).withColumn("_p", F.spark_partition_id()))
    names = [F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    open_pieces = with_rank(all_pieces.where(F.col("length") < capacity), "length")
    counts = {r["length"]: r["n"] for r in all_pieces.where(F.col("length") < capacity).groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = best_fit(counts, capacity)
    # A run covers ranks first .. first + count; it is cut at blocks of ranks, so that a plain equi-join finds it.
    block = max(1, max(counts.values(), default=1) // 64)
    table = spark.createDataFrame(runs, PLACED).select(
        F.col("length").alias("_length"),
        "first",
        "count",
        "sequence",
        "offset",
        F.explode(F.sequence(F.floor(F.col("first") / block), F.floor((F.col("first") + F.col("count") - 1) / block))).alias("_block"),
    )
    placed = (
        open_pieces.join(
            F.broadcast(table),  # at most 2 * capacity ** 2 runs (see above), and 127 block edges for each length
            (F.col("length") == F.col("_length")) & (F.floor(F.col("rank") / block) == F.col("_block"))
            & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("count")),
        )
        .withColumn("sequence_id", F.col("sequence") + F.col("rank") - F.col("first"))
        .withColumn("offset", F.col("offset").cast("long"))
        .select(*names)
    )
    whole = all_pieces.where(F.col("length") == capacity)
    alone = whole.withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    return placed.unionByName(alone.select(*names))


