"""Classification of README texts by ordered keyword rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.keywords import (
    CLOUD_KEYWORDS,
    DEPLOYMENT_KEYWORDS,
    all_keywords,
    cloud_of,
    deployment_of,
    keyword_hits,
)

Rules = Mapping[str, Sequence[str]]


def deployment_by_keyword(
    df: DataFrame, rules: Rules = DEPLOYMENT_KEYWORDS, col: str = "content"
) -> DataFrame:
    hits = df.withColumn("_hits", keyword_hits(F.col(col), all_keywords(rules)))
    found = hits.withColumn("_d", deployment_of(F.col("_hits"), rules))
    return found.select(*df.columns, "_d.deployment_type", "_d.reason")


def cloud_by_keyword(
    df: DataFrame, providers: Rules = CLOUD_KEYWORDS, col: str = "content"
) -> DataFrame:
    hits = df.withColumn("_hits", keyword_hits(F.col(col), all_keywords(providers)))
    return hits.withColumn("cloud", cloud_of(F.col("_hits"), providers)).drop("_hits")


def classify_text(
    df: DataFrame,
    rules: Rules = DEPLOYMENT_KEYWORDS,
    providers: Rules = CLOUD_KEYWORDS,
    col: str = "content",
) -> DataFrame:
    """Deployment type, reason and cloud of each text, from a single pass over it.

    A row without a text is Unknown in all three.
    """
    hits = df.withColumn("_hits", keyword_hits(F.col(col), all_keywords(rules, providers)))
    found = hits.withColumns(
        {"_d": deployment_of(F.col("_hits"), rules), "_c": cloud_of(F.col("_hits"), providers)}
    )
    has_text = F.col(col).isNotNull()
    or_unknown = lambda c: F.when(has_text, c).otherwise(F.lit("Unknown"))
    return found.select(
        *[c for c in df.columns if c not in ("deployment_type", "reason", "cloud")],
        or_unknown(F.col("_d.deployment_type")).alias("deployment_type"),
        or_unknown(F.col("_d.reason")).alias("reason"),
        or_unknown(F.col("_c")).alias("cloud"),
    )


def classify_by_keyword(
    projects: DataFrame,
    readmes: DataFrame,
    rules: Rules = DEPLOYMENT_KEYWORDS,
    providers: Rules = CLOUD_KEYWORDS,
    key: str = "project_url",
) -> DataFrame:
    """Classify projects by their README `(key, content[, status])`, one row per key.

    No URL, or no README, gives Unknown throughout. A landed status 'request
    failed' gives Error throughout and 'failed' an Error as reason. Texts are
    classified before the join, so they are not shuffled.
    """
    status = "status" if "status" in readmes.columns else F.lit(None).cast("string").alias("status")
    texts = readmes.where(F.col(key).isNotNull()).select(
        key, status, F.lower("content").alias("content")
    )
    classified = classify_text(texts, rules, providers).drop("content")
    results = ("deployment_type", "reason", "cloud")
    kept = [c for c in projects.columns if c not in results]
    joined = projects.select(*kept).join(classified, key, "left")
    request_failed = F.col("status").eqNullSafe("request failed")
    failed = F.col("status").eqNullSafe("failed")

    def settled(c: str):
        on_failure = "Error" if c == "reason" else "Unknown"
        return (
            F.when(request_failed, "Error")
            .when(failed, on_failure)
            .otherwise(F.coalesce(c, F.lit("Unknown")))
            .alias(c)
        )

    return joined.select(*kept, *[settled(c) for c in results])


def unknown_rows(df: DataFrame, col: str = "cloud", key: str = "project_url") -> DataFrame:
    return df.where(F.col(col) == "Unknown").select(key)


def unknown_rate(df: DataFrame, col: str = "cloud") -> DataFrame:
    """Unknown and total rows, and their percentage; null for an empty table."""
    unknown, total = F.count_if(F.col(col) == "Unknown"), F.count(F.lit(1))
    return df.agg(
        unknown.alias("unknown"),
        total.alias("total"),
        F.try_divide(unknown * F.lit(100.0), total).alias("percent"),
    )
