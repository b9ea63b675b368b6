"""From documents to packed training sequences, in stages that each work on what the stage before kept.

Each stage takes (spark, docs, sf_dir), where docs has the columns of documents. `run`
writes what a stage returns as Parquet and reads it again for the next one. Stage 1
drops the documents that the classifier rejects; 2 keeps the smallest document of each
class of near copies; 3 takes repeated passages out of the texts; 4 repeats
or drops documents so that sources reach their weights; 5 packs what is left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import stored
from shelfmark.llm.jaccard_join import similar_sets
from shelfmark.llm.mixing import mix_sources
from shelfmark.llm.packing import pack
from shelfmark.llm.quality_classifier import quality_scores
from shelfmark.llm.queries import vocabulary
from shelfmark.llm.suffix_dedup import without_repeats


def _free(docs: DataFrame, name: str) -> str:
    """A column name like `name` that no column of `docs` has."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _numbered(docs: DataFrame, ordered: bool = False) -> tuple[DataFrame, str]:
    """`docs` with a number of its own for every row, and the name of that column, so that decisions find their rows.

    That is the doc_id where all rows have one of their own; nothing is copied then. Where ids are null or
    repeat, rows are numbered in a stored copy: by doc_id if `ordered`, null ids last, equal ones in any order.
    """
    row = _free(docs, "_row")
    if not docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").head(1):
        return docs.withColumn(row, F.col("doc_id").cast("long")), row
    rows = docs.orderBy(F.col("doc_id").asc_nulls_last()) if ordered else docs
    return stored(rows.withColumn(row, F.monotonically_increasing_id())), row


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject, each row by its own text.

    Null and empty texts are scored like others; rows of one id, or without one, each by itself; repeated rows share their
    fate; no documents give none; columns besides those of documents pass by.
    """
    rows, row = _numbered(docs)
    scores = quality_scores(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"), row_col=row)
    bad = scores.where("predicted = 0").select(F.col(row).alias(_free(rows, "_bad")))
    return rows.join(bad, rows[row] == bad[bad.columns[0]], "left_anti").select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each class of texts that share four in five of their five-word shingles.

    A class keeps one row, also where ids are null or repeat. A text without words is no copy of another. No documents
    give none; columns besides those of documents pass by.
    """
    rows, row = _numbered(docs, ordered=True)
    copies = similar_sets(rows, id_col=row).where(F.col(row) != F.col("component_id")).select(F.col(row).alias(_free(rows, "_copy")))
    return rows.join(copies, rows[row] == copies[copies.columns[0]], "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 bytes and more that one before them has; texts left without a character go.

    Before a row are those of smaller ids, and some order of the rows of its own id; null ids come last. Null and empty texts
    stay as they are. No documents give none; other columns pass by, but for those named as `without_repeats` names its own.
    """
    rows, row = _numbered(docs, ordered=True)
    made = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")
    aside = {c: _free(rows, f"_{c}") for c in docs.columns if c.lower() in made}
    cut = without_repeats(rows.withColumnsRenamed(aside), id_col=row)
    gone = (F.col("n_removed") > 0) & (F.trim("kept_text") == "")
    changed = cut.where(~gone | F.col("kept_text").isNull())
    text, n_chars = F.col("kept_text"), F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)
    keep = F.col("n_removed") == 0
    own = {"text": text, "n_chars": F.when(keep, F.col("n_chars")).otherwise(n_chars)}
    return changed.select(*[own.get(c, F.col(aside.get(c, c))).alias(c) for c in docs.columns])


def source_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those it does not take are left out.

    Null and empty texts have no words: they cost nothing and are drawn by their keys like others, at most twice.
    Null and repeated ids draw each row for itself, a null source is one of its own; no documents give none;
    columns besides those of documents pass by.
    """
    rows, row = _numbered(docs)
    mix = mix_sources(rows.select(row, "doc_id", "text", "source"), id_col=row, draw_col="doc_id").where("copies > 0")
    number, copies, each = (_free(rows, n) for n in ("_taken", "_copies", "_each"))
    taken = mix.select(F.col(row).alias(number), F.col("copies").alias(copies))
    drawn = rows.join(taken, F.col(row) == F.col(number))
    return drawn.withColumn(each, F.explode(F.array_repeat(F.lit(1), F.col(copies)))).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of document: where it lies in which sequence of 1024 tokens.

    Null and empty texts are their end alone; null and repeated ids are packed row by row; no documents give no pieces;
    other columns are left out.
    """
    return pack(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources to target weights", source_weights),
    ("best-fit packing", packing),
]

# Classifier and token ids are not for SQL; tests/llm/test_pipeline.py checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
