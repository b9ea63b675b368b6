"""Tables landed from outside: listing pages, repository trees, file payloads.

Requests themselves happen elsewhere; what they returned is read here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.repos import decode_payload

PAGES = "series_id string, page int, html string"
TREES = "owner string, repo string, branch string, tree array<struct<path:string,type:string>>"
PAYLOADS = "owner string, repo string, ref string, path string, type string, content string"
STATUS = "owner string, repo string, status_code int, default_branch string"
FOLDERS = "owner string, repo string, folder string, position int, name string, type string"


def read(spark: SparkSession, path: str, schema: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(schema).format(fmt).load(path)


def pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read(spark, path, PAGES, fmt)


def trees(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """One row per tree entry; a tree that was landed empty keeps one row without a path."""
    return read(spark, path, TREES, fmt).select(
        "owner", "repo", "branch", F.inline_outer("tree").alias("path", "type")
    )


def contents(spark: SparkSession, path: str, fmt: str = "json", n: int = 8000) -> DataFrame:
    """File texts `(owner, repo, ref, path, content)`; payloads without a text are left out."""
    raw = read(spark, path, PAYLOADS, fmt).withColumnRenamed("content", "content_b64")
    return decode_payload(raw, n=n).where(F.length("content") > 0).drop("type")


def status(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return read(spark, path, STATUS, fmt)


def folders(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return read(spark, path, FOLDERS, fmt)
