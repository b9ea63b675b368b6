"""Cleaning of submission lists and catalogue rows."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import mojibake_repaired, na_to_null
from shelfmark.functions.titles import uniform_wording, without_marks

KEY = "project_url"
RESULT_COLUMNS = ("project_title", "deployment_type", "reason", "cloud")


def strings(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string"]


def missing_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Read the usual missing-value tokens as null."""
    cols = strings(df) if cols is None else cols
    return df.withColumns({c: na_to_null(F.col(c)) for c in cols if c in df.columns})


def clean_and_deduplicate(
    df: DataFrame, col: str = KEY, drop_null_key: bool = False
) -> DataFrame:
    """Distinct values of one column, rows that are null throughout left out first.

    A row with other values only leaves one null key, unless `drop_null_key`.
    Without the column the rows stay, with a warning.
    """
    if col not in df.columns:
        warnings.warn(f"column {col!r} not found, only empty rows are dropped", stacklevel=2)
        return df.na.drop("all")
    keys = df.na.drop("all").select(col).distinct()
    return keys.where(F.col(col).isNotNull()) if drop_null_key else keys


def union_by_name(dfs: Iterable[DataFrame]) -> DataFrame:
    """Union of lists with differing headers; a column a list lacks is null."""
    dfs = list(dfs)
    if not dfs:
        raise ValueError("nothing to combine")
    result = dfs[0]
    for df in dfs[1:]:
        result = result.unionByName(df, allowMissingColumns=True)
    return result


def with_result_columns(df: DataFrame, cols: Sequence[str] = RESULT_COLUMNS) -> DataFrame:
    """Add the result columns a list does not have yet, as nulls."""
    absent = {c: F.lit(None).cast("string") for c in cols if c not in df.columns}
    return df.withColumns(absent) if absent else df


def update_titles(df: DataFrame, titles: DataFrame, key: str = KEY) -> DataFrame:
    """Replace the title column by the titles of a second table.

    A row without a new title gets null: the column is replaced as a whole. Of several titles of one key, null
    keys too, the smallest counts, so that no row is multiplied.
    """
    once = titles.groupBy(F.col(key).alias("_key")).agg(F.min("project_title").alias("_title"))
    kept = [F.col(c) for c in df.columns if c != "project_title"]
    joined = df.join(once, df[key].eqNullSafe(once["_key"]), "left")
    return joined.select(*kept, F.col("_title").alias("project_title"))


def _each(df: DataFrame, cols: Sequence[str], change) -> DataFrame:
    return df.withColumns({c: change(F.col(c)) for c in cols if c in df.columns})


def repair_mojibake(df: DataFrame, cols: Sequence[str] = ("project_title", "reason")) -> DataFrame:
    return _each(df, cols, mojibake_repaired)


def clean_titles(df: DataFrame, col: str = "project_title") -> DataFrame:
    return _each(df, [col], without_marks)


def normalise_titles(df: DataFrame, col: str = "project_title") -> DataFrame:
    return _each(df, [col], uniform_wording)
