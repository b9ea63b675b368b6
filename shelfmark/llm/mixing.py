"""Mixing sources to target weights by Efraimidis-Spirakis sampling. Native columns only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import WORD, stored

#: Key ranges of a source that are summed before any row is sorted.
RANGES = 4096


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Sources by code point, null last, weigh `weights` in turn and divide `share` times
    all sizes. A target stops at `most` times its source; the excess goes to the
    others by weight. In order of size against weight, the sources that stop come
    first, and the level of the others follows from running sums: no iteration.
    """
    line = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(float(w)) for w in weights])
    named = sizes.withColumn("w", F.element_at(turn, (F.row_number().over(line) - 1) % len(weights) + 1))
    named = named.withColumn("cap", F.lit(most) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    level = named.withColumn("level", left / weight_left)
    free = F.when(F.col("cap") / F.col("w") > F.col("level"), F.col("level"))
    level = level.withColumn("level", F.max(free).over(whole))
    return level.select(
        "source",
        "source_size",
        F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("w") * F.col("level"))).alias("target"),
    )


def sampling_key(id_col: Column, weight: Column, seed: str) -> Column:
    """An exponential key of rate `weight`: small keys are drawn first, and reruns agree."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"))
    unit = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    return -F.log(unit) / weight


def word_quality(text: Column) -> Column:
    """A quality weight in [0.05, 1]: less for texts full of symbols."""
    length = F.char_length(text)
    symbols = length - F.char_length(F.translate(text, "#*$%&|<>", ""))
    return F.greatest(F.lit(0.05), 1 - 4.0 * symbols / F.greatest(length, F.lit(1)))


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    quality: Column | None = None,
    draw_col: str | None = None,
) -> DataFrame:
    """How many words of each document the mix takes: (id, source, size, source_size, target, taken, copies).

    Complete epochs come first: every document of a source is taken as often as the
    source fits whole into its target. What is left of the target goes to documents in
    the order of their keys until their sizes reach it; the document at the edge is
    taken when that comes nearer. Key ranges are summed per source, and rows are
    sorted only within a range, so that a source with most rows is spread as well.

    A null text has size 0 and takes nothing; a null source is a source of its own; a
    repeated row is drawn each for itself, with an equal key; a null id hashes as an
    empty one; equal keys are in the order of a hash of their texts, so rows draw alike in any arrangement; a row without
    words gets no more than `most` copies; keys are those of `draw_col` where that is not the id; an empty table gives an empty one. Other columns are dropped first.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(
        docs[id_col].alias("_id"),
        docs[source_col].alias("_source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        sampling_key(docs[draw_col or id_col], word_quality(text) if quality is None else quality, seed).alias("_key"),
        F.xxhash64(text).alias("_tie"),
    ).withColumn("_range", F.least(F.floor((1 - F.exp(-F.col("_key"))) * RANGES), F.lit(RANGES - 1)))
    rows = stored(rows)
    ranges = rows.groupBy("_source", "_range").agg(F.sum("size").alias("_sum"))
    sizes = ranges.groupBy(F.col("_source").alias("source")).agg(F.sum("_sum").alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    in_order = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    plan = (
        ranges.withColumn("_below", F.coalesce(F.sum("_sum").over(in_order), F.lit(0)))
        .join(targets, F.col("_source").eqNullSafe(F.col("source")))
        .withColumn("_epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size"))
        .select(F.col("source"), F.col("_range").alias("_r"), "source_size", "target", "_epochs", "_rest", "_below")
    )
    joined = rows.join(plan, F.col("_source").eqNullSafe(F.col("source")) & (F.col("_range") == F.col("_r")))
    running = Window.partitionBy("source", "_range").orderBy("_key", "_tie", "size", "_id").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("_below") + F.sum("size").over(running)
    drawn = upto.alias("_upto")
    chosen = joined.select("*", drawn).withColumn(
        "_more",
        (F.col("_rest") > 0)
        & (
            (F.col("_upto") <= F.col("_rest"))
            | ((F.col("_upto") - F.col("size") < F.col("_rest")) & (F.col("_upto") - F.col("_rest") < F.col("_rest") - (F.col("_upto") - F.col("size"))))
        ),
    )
    copies = (F.col("_epochs") + F.col("_more").cast("int")).cast("int")
    return chosen.select(
        F.col("_id").alias(id_col),
        F.col("_source").alias(source_col),
        "size",
        "source_size",
        "target",
        (F.col("size") * copies).cast("long").alias("taken"),
        copies.alias("copies"),
    )
