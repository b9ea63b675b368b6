"""Session defaults the operators are written against."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Skew handling is left to AQE where a join side cannot be made unique first: it
# splits an oversized partition, also where that costs one more shuffle later.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def session(app: str = "shelfmark", **conf: str) -> SparkSession:
    """A session with the defaults above; on a cluster the submitter's own settings win."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def reliable(df, scratch: str | None = None):
    """Cut the lineage of `df` with a reliable checkpoint.

    The folder is the cluster's own ``spark.checkpoint.dir``; `scratch` is used
    only where that is unset, as in a local test.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None) or scratch
        if folder is None:
            raise ValueError("set spark.checkpoint.dir, or pass a shared folder")
        context.setCheckpointDir(folder)
    return df.checkpoint()
