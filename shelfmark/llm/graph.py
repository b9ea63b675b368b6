"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import discard, stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link; component is the smallest node reachable.

    `links` has columns (a, b). Alternating star contractions: each node ties its larger
    neighbours to the smallest one it knows, then its smaller ones. Rounds grow with the
    logarithm of the longest chain; links are only ever grouped by node with partial minima.
    """
    edges = stored(
        links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    state = None
    while (now := edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()) != state:
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, edges = edges, stored(small.unionByName(least.withColumnRenamed("m", "v")).distinct())
        discard(before)
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
