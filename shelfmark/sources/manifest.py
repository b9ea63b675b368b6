"""A catalogue that is merged into by course, year and URL, one folder per course and year and version.

A merge writes the partitions it touches anew, into a folder of its own, and then one small manifest, which
names the folder of every partition. Readers go by the last manifest. So the files of other partitions are
left alone, and a merge that is lost halfway leaves the old state as it was: what it wrote no manifest names.

    base/data/version=<id>/course=<c>/year=<y>/part-*.parquet
    base/manifests/<number>/part-*.json      (course, year, version), one file
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.operators.clean import RESULT_COLUMNS
from shelfmark.operators.enrich import first_per_key, keyed, same_key
from shelfmark.sources.catalogue import SCHEMA, select_partitions

KEYS = ("course", "year", "project_url")
PARTITION = ("course", "year")
ROWS = "course string, year string, version string"
DIGITS = 9


def _manifests(spark: SparkSession, base: str) -> DataFrame | None:
    """All manifests, `(number, course, year, version)`; None before the first. One that was not finished has no file."""
    read = spark.read.schema(ROWS)
    try:
        found = read.json(f"{base.rstrip('/')}/manifests/*/*.json")
    except Exception as failure:
        if "PATH_NOT_FOUND" in str(failure):
            return None
        raise
    number = F.regexp_extract(F.col("_metadata.file_path"), rf"/manifests/(\d{{{DIGITS}}})/[^/]*$", 1)
    return found.select(number.cast("int").alias("number"), "course", "year", "version")


def current(spark: SparkSession, base: str) -> tuple[int, dict[tuple[str | None, str | None], str]]:
    """The number of the last manifest, 0 without one, and the version of every partition.

    The driver holds a name for each course and year, as it does for the folders of any partitioned table.
    """
    found = _manifests(spark, base)
    if found is None:
        return 0, {}
    last = found.agg(F.max("number")).first()[0]
    if last is None:
        return 0, {}
    rows = found.where(F.col("number") == last).collect()
    return last, {(r["course"], r["year"]): r["version"] for r in rows}


def _of(parts: dict[tuple[str | None, str | None], str]) -> Column:
    """Whether a row lies in these partitions: conditions on partition columns alone, so others are not read."""
    by_version: dict[str, list] = {}
    for (course, year), version in parts.items():
        by_version.setdefault(version, []).append((course, year))
    same = lambda c, y: F.col("course").eqNullSafe(F.lit(c)) & F.col("year").eqNullSafe(F.lit(y))
    either = lambda conditions: reduce(lambda a, b: a | b, conditions)
    return either([(F.col("version") == v) & either([same(*p) for p in own]) for v, own in by_version.items()])


def _read(spark: SparkSession, base: str, parts: dict[tuple[str | None, str | None], str]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], SCHEMA)
    schema = T.StructType([*SCHEMA.fields, T.StructField("version", T.StringType())])
    folder = f"{base.rstrip('/')}/data"
    found = spark.read.schema(schema).option("basePath", folder)
    paths = [f"{folder}/version={v}" for v in sorted(set(parts.values()))]
    return found.parquet(*paths).where(_of(parts)).select(*SCHEMA.names)


def load_current(
    spark: SparkSession, base: str, courses: Sequence[str] | None = None, years: Sequence[str] | None = None
) -> DataFrame:
    """Rows of the selected courses and years as of the last manifest; files of others are not read."""
    _, parts = current(spark, base)
    wanted = {
        (c, y): v
        for (c, y), v in parts.items()
        if (courses is None or c in courses) and (years is None or y in [str(n) for n in years])
    }
    return select_partitions(_read(spark, base, wanted), courses, years)


def merged(old: DataFrame, new: DataFrame, order_by: Sequence[str | Column] = RESULT_COLUMNS) -> DataFrame:
    """`old` with the rows of `new` in place of those of the same course, year and URL; null is a value.

    Of several new rows of a key the first in the given order counts.
    """
    once = first_per_key(new.select(*SCHEMA.names), order_by, KEYS)
    keys = once.select(*keyed(once, KEYS, "n"))
    return old.join(keys, same_key(KEYS, "n"), "left_anti").unionByName(once)


def upsert(
    df: DataFrame,
    base: str,
    order_by: Sequence[str | Column] = RESULT_COLUMNS,
    before_commit: Callable[[], None] | None = None,
) -> int:
    """Merge catalogue rows into the table at `base`; the number of the new manifest.

    Only partitions with a row in `df` are read and written. `df` is read twice, for the names of these partitions and
    for its rows. Two merges at a time end with the later one failing at its manifest, since the
    folder of that number is there: the earlier one stands, and the later one is to be run again.
    `before_commit` runs between the rows and the manifest.
    """
    spark = df.sparkSession
    number, parts = current(spark, base)
    touched = [(r["course"], r["year"]) for r in df.select(*PARTITION).distinct().collect()]
    if not touched:
        return number
    held = _read(spark, base, {p: v for p, v in parts.items() if p in touched})
    version = uuid.uuid4().hex
    folder = base.rstrip("/")
    rows = merged(held, df, order_by)
    rows.hint("rebalance", *PARTITION).write.partitionBy(*PARTITION).parquet(f"{folder}/data/version={version}")
    if before_commit:
        before_commit()
    now = {**parts, **dict.fromkeys(touched, version)}
    names = spark.createDataFrame([(c, y, v) for (c, y), v in now.items()], ROWS)
    names.coalesce(1).write.mode("errorifexists").json(f"{folder}/manifests/{number + 1:0{DIGITS}d}")
    return number + 1


def unused_versions(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Versions that none of the last `keep` manifests names, for whoever clears old files."""
    found = _manifests(spark, base)
    if found is None:
        return []
    last = found.agg(F.max("number")).first()[0]
    used = found.where(F.col("number") > last - keep).select("version").distinct()
    every = found.select("version").distinct()
    return sorted(r["version"] for r in every.join(used, "version", "left_anti").collect())
