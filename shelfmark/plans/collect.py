"""From landed listing pages to the catalogue, in one run; and classification from READMEs, from URL to label."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from time import monotonic

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.answers import strictly_decoded
from shelfmark.operators.clean import KEY
from shelfmark.operators.courses import course_outcomes
from shelfmark.operators.enrich import run_metrics
from shelfmark.operators.keywords import classify_by_keyword
from shelfmark.operators.pages import page_links, scraped, series_states
from shelfmark.operators.repos import readme_of
from shelfmark.operators.urls import locate_readmes, readme_candidates
from shelfmark.plans.enrichment import Answers, run
from shelfmark.sources import manifest
from shelfmark.streaming.incremental import worklist


def collected(courses: DataFrame, pages: DataFrame) -> DataFrame:
    """`(course, year, project_url, score)`: what the listing pages of the given courses name, each URL once a course.

    `courses` are `(name, year, slug)`, `pages` are `(slug, page, html)`. Pages of other courses are left out before
    their HTML is looked at.
    """
    named = courses.select("slug", F.col("name").alias("course"), F.col("year").cast("string").alias("year"))
    wanted = pages.join(named.select("slug").distinct(), "slug", "left_semi")
    return scraped(wanted, "slug").join(named, "slug").select("course", "year", KEY, "score")


@dataclass
class Result:
    """What a run did: the number of the manifest it wrote, the states of listings, courses and rows."""

    manifest: int
    listings: DataFrame
    outcomes: DataFrame
    metrics: DataFrame


def update_catalogue(
    courses: DataFrame,
    pages: DataFrame,
    trees: DataFrame,
    contents: DataFrame,
    status: DataFrame,
    answers: Answers,
    base: str,
    mode: str = "missing",
    types: Mapping[str, Sequence[str]] | None = None,
    limit: int = 0,
    **single,
) -> Result:
    """One run: choose courses, collect and clean their lists, enrich what needs it, merge it into the catalogue.

    `mode` chooses the courses (`streaming.incremental.worklist`; `single` holds its further settings). In mode
    `retry` the rows of the catalogue itself are worked on again. Only the courses of the run are
    rewritten; a run that is lost leaves the catalogue as it was. A course whose listing names nothing is not ok.
    """
    spark, begin = pages.sparkSession, monotonic()
    current = manifest.load_current(spark, base)
    work = answers.keep(worklist(courses, current, mode, **single).select("name", "year", "slug"))
    own = work.select(F.col("name").alias("course"), F.col("year").cast("string").alias("year")).distinct()
    if mode == "retry":
        listed = current.join(own, ["course", "year"], "left_semi").select("course", "year", KEY)
    else:
        listed = collected(work, pages).select("course", "year", KEY).distinct()
    done = answers.keep(run(listed, current, trees, contents, status, answers, types, limit))
    number = manifest.upsert(done, base)
    mine = pages.join(work.select("slug").distinct(), "slug", "left_semi")
    return Result(
        number,
        series_states(page_links(mine, "slug"), "slug"),
        course_outcomes(work, done),
        run_metrics(done, monotonic() - begin),
    )


def classify_from_readmes(projects: DataFrame, entries: DataFrame, files: DataFrame) -> DataFrame:
    """Deployment type, reason and cloud of every project by the words of its README, from its URL on.

    `projects` are `(project_url, ...)`, unique; `entries` are listings of folders `(owner, repo, folder, position, name,
    type)`, `files` are payloads `(owner, repo, path, content_b64)`. Where the URL points, the README is looked up as it is
    spelled there; its payload is decoded as a whole, or from the fallback path (without the first `branch/`) where the
    first has none; a payload that cannot be decoded is no README. Of payloads landed
    several times the smallest text counts. Texts are classified before they are joined to projects.
    """
    keys = ["owner", "repo"]
    located = locate_readmes(projects.select(KEY).where(F.col(KEY).isNotNull()))
    named = readme_candidates(readme_of(located, entries, keys))
    wanted = named.select(KEY, *keys, F.explode(F.array("path", "fallback_path")).alias("path"), "fallback_path")
    wanted = wanted.where(F.col("path").isNotNull())
    wanted = wanted.select(KEY, *keys, "path", (F.col("path") != F.coalesce("fallback_path", F.lit(""))).alias("_first")).distinct()
    asked = wanted.select(*keys, "path").distinct()
    decoded = files.join(asked, [*keys, "path"], "left_semi").select(*keys, "path", strictly_decoded(F.col("content_b64")).alias("content"))
    texts = decoded.where(F.length("content") > 0).groupBy(*keys, "path").agg(F.min("content").alias("content"))
    best = F.max_by("content", F.struct(F.col("_first"), "path"))
    readmes = wanted.join(texts, [*keys, "path"]).groupBy(KEY).agg(best.alias("content"))
    return classify_by_keyword(projects, readmes)
