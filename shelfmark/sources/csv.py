"""Headered CSV lists: reading, combining by name, checking, writing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.operators.clean import clean_and_deduplicate, missing_to_null
from shelfmark.sources.csv_splits import header_records, records

REQUIRED = ("project_url",)
#: Files whose headers may be broadcast; those of more are shuffled.
BROADCAST_FILES = 200_000
READ_OPTIONS = {"header": True, "multiLine": True, "escape": '"', "mode": "PERMISSIVE"}


def string_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def parsed(text: Column, names: Sequence[str]) -> Column:
    """A record as a struct of text values; values that lack are null."""
    kind = ",".join(f"`{n.replace('`', '``')}` string" for n in names)
    return F.from_csv(text, kind, {k: v for k, v in READ_OPTIONS.items() if k != "header"})


def scan_csv(
    spark: SparkSession, path: str | Sequence[str] | DataFrame, schema: T.StructType | None = None
) -> DataFrame:
    """One list, all columns text, missing-value tokens as null; a DataFrame is taken as it is.

    Several paths must share one header; without a schema the names come from it. A file of any size is
    read in splits, also where quoted values hold line ends.
    """
    if isinstance(path, DataFrame):
        return path
    if not isinstance(path, (str, list, tuple)):
        raise ValueError("input must be a path, paths or a DataFrame")
    if schema is None:
        first = header_records(spark, path).agg(F.min_by("text", "file").alias("text"))
        found = first.select(header_names(F.col("text")).alias("names")).first()["names"]
        names = [n or f"_c{i}" for i, n in enumerate(found or [])]
    else:
        names = schema.names
    rows = records(spark, path).where("start > 0 OR nth > 0")
    if not names:
        return rows.limit(0).select()
    return missing_to_null(rows.select(parsed(F.col("text"), names).alias("_r")).select("_r.*"))


def header_names(line: Column) -> Column:
    """The names of a header line; a quoted name may hold commas and doubled quotes."""
    fields = F.regexp_extract_all(line, F.lit(r'(?:^|,)(?:\s*"(?:[^"]|"")*"\s*|[^,]*)'), F.lit(0))
    bare = lambda f: F.btrim(F.regexp_replace(f, "^,", ""), F.lit(" \t\r"))
    unquoted = lambda n: F.when(
        n.rlike('^".*"$'), F.replace(n.substr(F.lit(2), F.length(n) - 2), F.lit('""'), F.lit('"'))
    ).otherwise(F.btrim(n, F.lit('"')))
    return F.transform(F.transform(fields, bare), unquoted)


def headers(spark: SparkSession, paths: str | Sequence[str], glob: str = "*.csv") -> DataFrame:
    """`(file, header, late)` of every CSV file: the names of its header.

    A record of nothing but commas is no header; `late` tells that such records stand before it.
    """
    found = header_records(spark, paths, glob)
    return found.select("file", header_names(F.col("text")).alias("header"), "late")


def combine_files(spark: SparkSession, paths: str | Sequence[str], glob: str = "*.csv") -> DataFrame:
    """Union by name of all CSV lists below the paths; an error if there are none.

    One read over lists with differing headers would shift their columns, so each record is taken apart
    by the header of its own file, all in one pass. The driver sees the distinct headers, not the files.
    Empty rows of lists with empty records above their header are left out.
    """
    heads = header_records(spark, paths, glob).withColumn("header", header_names(F.col("text")))
    shapes = heads.groupBy("header").agg(F.count("*").alias("n"), F.bool_or("late").alias("late")).collect()
    if not shapes:
        raise ValueError(f"no CSV files found in {paths}")
    shapes.sort(key=lambda s: (s["late"], s["header"]))
    rows = records(spark, paths, glob)
    if len(shapes) == 1 and not shapes[0]["late"]:
        return missing_to_null(rows.where("start > 0 OR nth > 0").select(parsed(F.col("text"), shapes[0]["header"]).alias("_r")).select("_r.*"))
    number = F.lit(None).cast("int")
    for i, s in enumerate(shapes):
        number = F.when(F.col("header") == F.array(*[F.lit(n) for n in s["header"]]), i).otherwise(number)
    own = heads.select("file", number.alias("_shape"), F.struct("start", "nth").alias("_head"), "late")
    own = F.broadcast(own) if sum(s["n"] for s in shapes) <= BROADCAST_FILES else own
    below = rows.join(own, "file").where(F.struct("start", "nth") > F.col("_head"))
    structs = [F.when(F.col("_shape") == i, parsed(F.col("text"), s["header"])).alias(f"_r{i}") for i, s in enumerate(shapes)]
    taken = below.select("late", *structs)
    names = list(dict.fromkeys(n for s in shapes for n in s["header"]))
    value = lambda n: F.coalesce(*[F.col(f"_r{i}")[n] for i, s in enumerate(shapes) if n in s["header"]])
    listed = missing_to_null(taken.select("late", *[value(n).alias(n) for n in names]))
    filled = F.coalesce(*[F.col(_quoted(n)) for n in names]).isNotNull()
    return listed.where(~F.col("late") | filled).select(*[_quoted(n) for n in names])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def scan_cleaned(spark: SparkSession, path: str, key: str = "project_url") -> DataFrame:
    """All cleaned lists below a path, cleaned again."""
    combined = combine_files(spark, path, "*cleaned_scraped_*.csv")
    return clean_and_deduplicate(combined, key)


def validate_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    required: Sequence[str] = REQUIRED,
    glob: str = "*.csv",
) -> DataFrame:
    """`(file, ok, missing)` for every CSV file: whether its header has the required columns."""
    needed = F.array(*[F.lit(c) for c in required])
    missing = F.array_except(needed, F.col("header"))
    return headers(spark, paths, glob).select(
        "file", (F.size(missing) == 0).alias("ok"), missing.alias("missing")
    )


def validate_changed(
    spark: SparkSession, files: Sequence[str], required: Sequence[str] = REQUIRED
) -> bool:
    """Whether all CSV files among the changed ones are valid; an unreadable one is not."""
    changed = [f.strip() for f in files if f.strip().endswith(".csv")]
    if not changed:
        return True
    try:
        result = validate_files(spark, changed, required)
        seen = result.agg(F.count(F.lit(1)).alias("n"), F.bool_and("ok").alias("ok")).first()
    except Exception as failure:
        if "PATH_NOT_FOUND" in str(failure):
            return False
        raise
    # An empty file has no header and so no row here.
    return bool(seen["ok"]) and seen["n"] == len(set(changed))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_scraped(df: DataFrame, path: str) -> None:
    """`(course, year, project_url, score)` as one folder per course and year."""
    table = df.select("course", "year", "project_url", F.coalesce("score", F.lit("")).alias("score"))
    write_partitioned(table, path, "csv")


def write_partitioned(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write by course and year, replacing only the partitions that are written.

    The rebalance hint gathers the rows of a partition into few files, and lets
    AQE split a course that holds most rows over several tasks.
    """
    (
        df.hint("rebalance", "course", "year")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .option("escape", '"')
        .partitionBy("course", "year")
        .format(fmt)
        .save(path)
    )


def export_filtered(df: DataFrame, path: str) -> bool:
    """Write a filtered view as CSV; an empty one is not written. Tells whether it was."""
    if df.isEmpty():
        return False
    listed = [
        F.array_join(c, " ").alias(c) if kind.startswith("array") else F.col(c)
        for c, kind in df.dtypes
    ]
    write_csv(df.select(*listed), path)
    return True
