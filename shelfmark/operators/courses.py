"""Discovery of courses and the choice of those to work on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.answers import ALL_TYPES
from shelfmark.functions.urls import course_slug


def listing_url(slug: Column, base: str) -> Column:
    return F.concat(F.lit(base + "/"), slug, F.lit("/projects"))


def page_url(url: Column, page: Column) -> Column:
    return F.when(page > 1, F.concat(url, F.lit("?page="), page.cast("string"))).otherwise(url)


def listing_urls(courses: DataFrame, base: str, pages: int = 1) -> DataFrame:
    """The listing page addresses of each course, pages 1 to `pages`."""
    numbered = courses.withColumn("page", F.explode(F.sequence(F.lit(1), F.lit(pages))))
    return numbered.withColumn("page_url", page_url(listing_url(F.col("slug"), base), F.col("page")))


def tracked_name(slug: Column, tracked: Mapping[str, str]) -> Column:
    """Name of the first tracked prefix the slug starts with; null if none.

    The prefixes are settings, few and known, so they become one expression and
    not a join.
    """
    return F.coalesce(*[F.when(slug.startswith(p), name) for p, name in tracked.items()])


def name_by_prefix(slugs: DataFrame, tracked: DataFrame, slug: str = "slug") -> DataFrame:
    """Rows with `name`, that of the first tracked prefix their slug starts with; rows without one are left out.

    `tracked` is a table `(prefix, name, position)` of any size; the smallest position is the first. A slug is listed
    under each of its beginnings, as long as the longest prefix at most, so that an equal join finds its prefixes; rows meet
    them once for each distinct slug. Equal positions go by prefix, an empty prefix fits every slug.
    """
    longest = tracked.agg(F.max(F.length("prefix"))).first()[0] or 0
    length = F.least(F.length(slug), F.lit(longest))
    beginnings = F.transform(F.sequence(F.lit(0), length), lambda n: F.substring(F.col(slug), F.lit(1), n))
    listed = slugs.select(slug).where(F.col(slug).isNotNull()).distinct()
    listed = listed.select(slug, F.explode(beginnings).alias("prefix"))
    first = F.min_by("name", F.struct("position", "prefix")).alias("name")
    return slugs.join(listed.join(tracked, "prefix").groupBy(slug).agg(first), slug)


def discover(
    links: DataFrame, tracked: Mapping[str, str] | DataFrame, base: str, position: str = "link_id"
) -> DataFrame:
    """Tracked courses among home page links `(position, href)`, each slug once.

    What is tracked is a few settings {prefix: name}, which become one expression, or a table (see `name_by_prefix`).
    Where a slug stands first is not in the result, and its name and year depend
    on the slug alone, so repeats are dropped by a distinct that combines per
    partition; `position` is kept as the place of the first link.
    """
    parsed = links.select(F.col(position).alias("_pos"), course_slug(F.col("href")).alias("_c"))
    once = (
        parsed.where(F.col("_c").isNotNull())
        .groupBy(F.col("_c.slug").alias("slug"), F.col("_c.year").alias("year"))
        .agg(F.min("_pos").alias(position))
    )
    if isinstance(tracked, DataFrame):
        named = name_by_prefix(once, tracked)
    else:
        named = once.withColumn("name", tracked_name(F.col("slug"), tracked))
    return (
        named.where(F.col("name").isNotNull())
        .select("name", "year", "slug", listing_url(F.col("slug"), base).alias("url"), position)
        .orderBy("name", F.desc("year"), position)
    )


def _existing(catalogue: DataFrame) -> DataFrame:
    """Course and year of which the catalogue holds any row."""
    return (
        catalogue.select(
            F.col("course").alias("name"), F.expr("try_cast(year AS INT)").alias("year")
        )
        .where("name IS NOT NULL AND year IS NOT NULL")
        .distinct()
    )


def missing_courses(courses: DataFrame, catalogue: DataFrame) -> DataFrame:
    return courses.join(_existing(catalogue), ["name", "year"], "left_anti")


def existing_courses(courses: DataFrame, catalogue: DataFrame) -> DataFrame:
    return courses.join(_existing(catalogue), ["name", "year"], "left_semi")


def course_status(courses: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Courses with a flag that tells whether the catalogue has them."""
    have = _existing(catalogue).withColumn("_have", F.lit(True))
    joined = courses.join(have, ["name", "year"], "left")
    return joined.withColumn("has_data", F.coalesce("_have", F.lit(False))).drop("_have")


def totals(status: DataFrame) -> DataFrame:
    """How many courses there are, have data, and miss data."""
    return status.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("has_data").alias("have"),
        F.count_if(~F.col("has_data")).alias("missing"),
    )


def course_outcomes(courses: DataFrame, states: DataFrame) -> DataFrame:
    """Courses of a run with their rows, rows in error and `ok`, from the `status` of each row.

    A course is ok when its run left rows and every row came to a status. As in the
    runner, a row in error is counted and does not fail its course; a course that
    listed nothing, or was left half way, does.
    """
    ran = (
        states.select(F.col("course").alias("name"), F.expr("try_cast(year AS INT)").alias("year"), "status")
        .groupBy("name", "year")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("status") == "error").alias("errors"),
            F.bool_and(F.col("status").isNotNull()).alias("ok"),
        )
    )
    joined = courses.join(ran, ["name", "year"], "left")
    return joined.withColumns(
        {"rows": F.coalesce("rows", F.lit(0)), "errors": F.coalesce("errors", F.lit(0)), "ok": F.coalesce("ok", F.lit(False))}
    )


def run_result(outcomes: DataFrame, ok: str = "ok") -> DataFrame:
    """How many courses of a run were done, and whether all were."""
    done, total = F.count_if(ok), F.count(F.lit(1))
    return outcomes.agg(done.alias("done"), total.alias("total"), (done == total).alias("all_ok"))


def single_course(
    spark, name: str, year: int, tracked: Mapping[str, str], base: str
) -> DataFrame:
    """One tracked course by name and year, whether or not it was discovered."""
    prefix = next((p for p, n in tracked.items() if n == name), None)
    if prefix is None:
        raise ValueError(f"unknown course {name!r}, known: {sorted(set(tracked.values()))}")
    slug = F.lit(f"{prefix}-{year}")
    return spark.range(1).select(
        F.lit(name).alias("name"),
        F.lit(int(year)).alias("year"),
        slug.alias("slug"),
        listing_url(slug, base).alias("url"),
    )


def with_valid_types(
    df: DataFrame,
    types: Mapping[str, Sequence[str]],
    default: Sequence[str] = ALL_TYPES,
    course: str = "course",
) -> DataFrame:
    """Add the deployment types valid for each row's course; the default for other courses."""
    array = lambda labels: F.array(*[F.lit(t) for t in labels])
    chosen = F.coalesce(
        *[F.when(F.col(course) == name, array(labels)) for name, labels in types.items()],
        array(default),
    )
    return df.withColumn("valid_types", chosen)
