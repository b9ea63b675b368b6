"""Ranked search the other way round: documents stream past an index of the items that look for them.

The terms of all items are one small inverted index. A first pass over the documents counts how many
hold each of these terms, a second scores each document for every item it shares a term with.
A task keeps a bounded heap of the best documents of each item, and heaps merge at the end,
so the documents themselves are never indexed, sorted or shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import stored
from shelfmark.llm.plain_words import byte_parts, plain_words

#: Postings of an index that is broadcast; more items than that are searched for in several blocks.
POSTINGS = 500_000
#: Scores of documents by items that are held at once.
CELLS = 1 << 21
#: Scores a task may hold for its heaps before it cuts them to the best.
WAITING = 1 << 19


class Index(NamedTuple):
    """Items by term: postings[at[t]:at[t + 1]] are the places of the items that hold term t, `often` how often each does."""

    terms: dict[bytes, int]
    at: np.ndarray
    postings: np.ndarray
    often: np.ndarray
    n_items: int


def item_terms(items: DataFrame) -> DataFrame:
    """(item, term, often) of items (item, text); the rows of one item are one text."""
    kind = items.schema["item"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in byte_parts(batch):
                for i, raw in enumerate(texts):
                    counted = Counter(plain_words(raw))
                    if counted:
                        yield pa.RecordBatch.from_arrays(
                            [rows.column("item").take(pa.array([i] * len(counted))), pa.array(list(counted), pa.binary()), pa.array(list(counted.values()), pa.int64())],
                            ["item", "term", "often"],
                        )

    found = items.mapInArrow(run, f"item {kind}, term binary, often long")
    return found.groupBy("item", "term").agg(F.sum("often").alias("often"))


def in_blocks(postings: DataFrame, limit: int) -> list[DataFrame]:
    """Postings in blocks of at most `limit` rows, all of an item in one; only a block of one item may have more.

    Items are dealt to buckets by hash, and neighbouring buckets that fit together are a block. The
    driver sees the sizes of the buckets, which are split until none of several items is too large.
    """
    buckets = 1 << 10
    while True:
        dealt = postings.withColumn("bucket", F.pmod(F.xxhash64("item"), F.lit(buckets)).cast("int"))
        sizes = dealt.groupBy("bucket").agg(F.count("*").alias("n"), (F.min("item") != F.max("item")).alias("several")).orderBy("bucket").collect()
        if buckets >= 1 << 18 or not any(s["several"] and s["n"] > limit for s in sizes):
            break
        buckets <<= 4
    edges, held = [0], 0
    for s in sizes:
        if held and held + s["n"] > limit:
            edges.append(s["bucket"])
            held = 0
        held += s["n"]
    return [dealt.where(F.col("bucket").between(lo, hi - 1)).drop("bucket") for lo, hi in zip(edges, [*edges[1:], buckets])]


def index_of(rows: pa.Table) -> tuple[Index, pa.Array]:
    """The index of one block of postings, and its items."""
    names = pa.concat_arrays(rows.column("item").chunks).dictionary_encode(null_encoding="encode") if rows.num_rows else pa.array([], rows.schema.field("item").type).dictionary_encode()
    terms: dict[bytes, int] = {}
    numbers = np.array([terms.setdefault(t, len(terms)) for t in rows.column("term").to_pylist()], np.int64)
    order = np.argsort(numbers, kind="stable")
    at = np.searchsorted(numbers[order], np.arange(len(terms) + 1))
    place = names.indices.to_numpy().astype(np.int64)[order]
    return Index(terms, at, place, rows.column("often").to_numpy()[order], len(names.dictionary)), names.dictionary


def corpus_counts(docs: DataFrame, index) -> tuple[int, int, np.ndarray]:
    """Documents with a term, their terms with repeats, and the documents that hold each term of the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = index.value.terms
        held = np.zeros(len(terms), np.int64)
        n_docs = n_terms = 0
        for batch in batches:
            for _, texts in byte_parts(batch):
                for words in map(plain_words, texts):
                    n_docs += bool(words)
                    n_terms += len(words)
                    held[[t for t in set(map(terms.get, words)) if t is not None]] += 1
        some = np.flatnonzero(held)
        numbers = np.concatenate(([-2, -1], some))
        yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(np.concatenate(([n_docs, n_terms], held[some])))], ["term", "n"])

    counted = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in counted.collect()}  # a row for each term of the index at most
    df = np.array([found.get(t, 0) for t in range(len(index.value.terms))], np.int64)
    return found.get(-2, 0), found.get(-1, 0), df


def term_weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


class Heaps:
    """The k best documents of each item: by score, then by smaller id, ids that are null last."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.zeros(n_items, np.int64)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.waiting = 0

    def add(self, item: np.ndarray, score: np.ndarray, known: np.ndarray, doc: np.ndarray) -> None:
        keep = score >= np.maximum(self.least[item], 1)
        if keep.any():
            self.parts.append((item[keep], score[keep], known[keep], doc[keep]))
            self.waiting += int(keep.sum())
            if self.waiting > WAITING:
                self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        columns = [np.concatenate(c) for c in zip(*self.parts)]
        item, score, known, doc = columns
        order = np.lexsort((doc, ~known.astype(bool), -score, item))
        item = item[order]
        new = np.ones(len(item), bool)
        new[1:] = item[1:] != item[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(len(item)), 0))
        rank = np.arange(len(item)) - first
        best = order[rank < self.k]
        full = rank == self.k - 1
        self.least[item[full]] = score[order][full]
        rest = tuple(c[best] for c in columns)
        self.parts, self.waiting = [rest], len(best)
        return rest


def lexical_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    limit: int = POSTINGS,
) -> DataFrame:
    """(item, rank, id, score): the `k` documents of highest score above 0 for every item.

    Scores are those of BM25 in whole numbers, summed over the terms of an item with repeats: a term's
    weight is floor(1000 ln((2N + 2) / (2 df + 1))), and it counts by 10^9 tf / (1000 tf + 8 m), where
    m is 25 plus 75 times the length of the document against the mean. Equal scores rank by id, null ids last.

    Ids are whole numbers. A null text has no term; a document without a term is in no count; repeated rows
    are documents of their own; the rows of one item are one text; an item without a term, or whose terms no
    document has, returns nothing; null items are one item. Other columns are dropped. Without documents
    or items there are no rows.

    The index is collected on the driver and broadcast in blocks of at most `limit` postings (or one item),
    with two passes over the documents for each block.
    """
    spark = docs.sparkSession
    lean = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    asked = items.select(items[item_col].alias("item"), items[item_text_col].alias("text"))
    kind = asked.schema["item"].dataType.simpleString()
    found = [searched(spark, lean, block, kind, k) for block in in_blocks(stored(item_terms(asked)), limit)]
    heaps = found[0]
    for more in found[1:]:
        heaps = heaps.unionByName(more)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def searched(spark, docs: DataFrame, postings: DataFrame, kind: str, k: int) -> DataFrame:
    """(item, id, score): the best documents of each task for the items of one block."""
    table = postings.toArrow()
    index_rows, names = index_of(table)
    index = spark.sparkContext.broadcast(index_rows)
    n_docs, n_terms, df = corpus_counts(docs, index)
    weights = term_weights(n_docs, df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, at, places, often, n_items = index.value
        heaps = Heaps(n_items, k)
        width = max(1, CELLS // max(1, n_items))  # documents scored at once

        def scored(known: np.ndarray, ids: np.ndarray, found: list[dict[int, int]], lengths: list[int]) -> None:
            m = 25 + 75 * np.array(lengths, np.int64) * n_docs // n_terms
            doc = np.repeat(np.arange(len(found)), [len(f) for f in found])
            term = np.array([t for f in found for t in f], np.int64)
            tf = np.array([c for f in found for c in f.values()], np.int64)
            part = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
            count = at[term + 1] - at[term]
            entry = np.repeat(np.arange(len(term)), count)
            spot = np.arange(len(entry)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(at[term], count)
            cell = doc[entry] * n_items + places[spot]
            total = np.zeros(len(found) * n_items, np.int64)
            np.add.at(total, cell, part[entry] * often[spot])
            hit = np.flatnonzero(total)
            heaps.add(hit % n_items, total[hit], known[hit // n_items], ids[hit // n_items])

        for batch in batches:
            for rows, texts in byte_parts(batch):
                ids = rows.column("id").fill_null(0).to_numpy()
                known = rows.column("id").is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
                for lo in range(0, len(texts), width):
                    found, lengths, who = [], [], []
                    for i, raw in enumerate(texts[lo : lo + width], lo):
                        words = plain_words(raw)
                        counted = Counter(map(terms.get, words))
                        counted.pop(None, None)
                        if counted:
                            found.append(counted)
                            lengths.append(len(words))
                            who.append(i)
                    if found:
                        scored(known[who], ids[who], found, lengths)
        item, score, known, ids = heaps.cut()
        yield pa.RecordBatch.from_arrays(
            [names.take(pa.array(item)), pa.array(ids, mask=known == 0), pa.array(score)], ["item", "id", "score"]
        )

    return docs.mapInArrow(run, f"item {kind}, id long, score long")
