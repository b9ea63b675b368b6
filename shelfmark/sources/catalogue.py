"""The catalogue: enriched rows in one folder per course and year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.sources.csv import READ_OPTIONS, write_partitioned

# Column names of the exported file, in its order.
EXPORT_NAMES = {
    "project_url": "project_url",
    "project_title": "project_title",
    "deployment_type": "Deployment Type",
    "reason": "Reason",
    "cloud": "Cloud",
}
# Fixed value: the years that are looked through without a choice.
DEFAULT_YEARS = ("2021", "2022", "2023", "2024", "2025")

SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in (*EXPORT_NAMES, "course", "year")]
)


def write(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    write_partitioned(df.select(*SCHEMA.names), path, fmt)


def load(
    spark: SparkSession,
    path: str,
    courses: Sequence[str] | None = None,
    years: Sequence[str] | None = None,
    fmt: str = "parquet",
    schema: T.StructType = SCHEMA,
) -> DataFrame:
    """Rows of the selected courses and years; other folders are not read.

    A pair without a folder adds nothing. The year stays text.
    """
    options = READ_OPTIONS if fmt == "csv" else {}
    df = spark.read.schema(schema).options(**options).format(fmt).load(path)
    return select_partitions(df, courses, years)


def select_partitions(
    df: DataFrame, courses: Sequence[str] | None = None, years: Sequence[str] | None = None
) -> DataFrame:
    if courses is not None:
        df = df.where(F.col("course").isin(list(courses)))
    if years is not None:
        df = df.where(F.col("year").isin([str(y) for y in years]))
    return df


def years(df: DataFrame, default: Sequence[str] = DEFAULT_YEARS) -> DataFrame:
    """The years with data, ascending; the default list if there are none."""
    # Years are made distinct by a partial aggregate; what one task sorts are folder names.
    found = df.where(F.col("year").rlike(r"^\d+$")).select("year").distinct()
    listed = found.agg(F.sort_array(F.collect_list("year")).alias("years"))
    fallback = F.array(*[F.lit(y) for y in default])
    chosen = F.when(F.size("years") > 0, F.col("years")).otherwise(fallback)
    return listed.select(F.explode_outer(chosen).alias("year"))


def export_columns(df: DataFrame) -> DataFrame:
    """The five columns under the names of the exported file."""
    return df.select(*[F.col(c).alias(name) for c, name in EXPORT_NAMES.items()])


def paths(base: str, course: str, year: int | str) -> dict[str, str]:
    """Where the lists and results of a course and year lie."""
    folder = f"{base}/{course}/{year}"
    return {
        "base": base,
        "course": course,
        "year": str(year),
        "folder": folder,
        "cleaned": f"{folder}/cleaned_scraped_{course}_{year}.csv",
        "titles": f"{folder}/projects_{course}_{year}_cleaned_titles.csv",
        "data": f"{folder}/data.csv",
    }


def paths_of(file: str) -> dict[str, str]:
    """The same, from the path of any list `base/course/year/file`."""
    parts = file.split("/")
    if len(parts) < 4:
        raise ValueError(f"not a path base/course/year/file: {file}")
    return paths("/".join(parts[:-3]), parts[-3], parts[-2])
