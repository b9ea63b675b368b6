"""Queries over course discovery and worklists."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.functions.urls import course_slug
from shelfmark.operators import courses as co
from shelfmark.queries.enrich import _FIRST, WORK
from shelfmark.queries.enrich import states as row_states
from shelfmark.queries.registry import query
from shelfmark.queries.views import view
from shelfmark.streaming.incremental import worklist

TRACKED = {"de-track": "course_a", "ml-track": "course_b", "llm-track": "course_c"}
BASE = "https://courses.example.org"

_LINKS = "parsed AS (SELECT link_id, regexp_extract(href, '/([a-z][a-z0-9-]+-(\\d{4}))/?$', 1) AS slug FROM home_links)"
_COURSES = f"""{_LINKS},
named AS (SELECT slug, CAST(right(slug, 4) AS INT) AS year, min(link_id) AS link_id,
 CASE WHEN starts_with(slug, 'de-track') THEN 'course_a' WHEN starts_with(slug, 'ml-track') THEN 'course_b'
  WHEN starts_with(slug, 'llm-track') THEN 'course_c' END AS name
 FROM parsed WHERE slug <> '' GROUP BY slug),
courses AS (SELECT name, year, slug, '{BASE}/' || slug || '/projects' AS url, link_id FROM named WHERE name IS NOT NULL),
have AS (SELECT DISTINCT course AS name, CAST(year AS INT) AS year FROM submissions),
status AS (SELECT c.*, h.name IS NOT NULL AS has_data FROM courses c LEFT JOIN have h USING (name, year))"""
BOTH = ("home_links", "submissions")
COLUMNS = ("name", "year", "slug", "url")


def discovered(spark, d):
    return co.discover(view(spark, d, "home_links"), TRACKED, BASE)


def status(spark, d):
    return co.course_status(discovered(spark, d), view(spark, d, "submissions"))


@query(
    "course_links",
    f"WITH {_LINKS} SELECT link_id, slug, CAST(right(slug, 4) AS INT) AS year FROM parsed WHERE slug <> ''",
    ("home_links",),
)
def course_links(spark, d):
    parsed = view(spark, d, "home_links").withColumn("_c", course_slug(F.col("href")))
    return parsed.where(F.col("_c").isNotNull()).select("link_id", "_c.*")


@query("course_discover", f"WITH {_COURSES} SELECT name, year, slug, url FROM courses", BOTH)
def course_discover(spark, d):
    return discovered(spark, d).select(*COLUMNS)


@query("course_missing", f"WITH {_COURSES} SELECT name, year, slug, url FROM status WHERE NOT has_data", BOTH)
def course_missing(spark, d):
    return co.missing_courses(discovered(spark, d), view(spark, d, "submissions")).select(*COLUMNS)


@query("course_status", f"WITH {_COURSES} SELECT name, year, slug, url, has_data FROM status", BOTH)
def course_status(spark, d):
    return status(spark, d).select(*COLUMNS, "has_data")


@query(
    "course_totals",
    f"WITH {_COURSES} SELECT count(*) AS total, count(*) FILTER (has_data) AS have, "
    "count(*) FILTER (NOT has_data) AS missing FROM status",
    BOTH,
)
def course_totals(spark, d):
    return co.totals(status(spark, d))


@query(
    "run_result",
    f"WITH {_COURSES} SELECT count(*) FILTER (has_data) AS done, count(*) AS total, bool_and(has_data) AS all_ok FROM status",
    BOTH,
)
def run_result(spark, d):
    return co.run_result(status(spark, d), "has_data")


@query(
    "course_outcomes",
    f"""WITH {_FIRST}, listed AS (WITH {_COURSES} SELECT name, year FROM courses),
ran AS (SELECT o.course AS name, CAST(o.year AS INT) AS year, count(*) AS rows, count(*) FILTER (s.status = 'error') AS errors,
 bool_and(s.status IS NOT NULL) AS ok FROM submissions o LEFT JOIN states s USING (submission_id) GROUP BY ALL)
SELECT name, year, coalesce(rows, 0) AS rows, coalesce(errors, 0) AS errors, coalesce(ok, false) AS ok FROM listed LEFT JOIN ran USING (name, year)""",
    ("home_links", *WORK),
)
def course_outcomes(spark, d):
    outcomes = co.course_outcomes(discovered(spark, d), row_states(spark, d))
    return outcomes.select("name", "year", "rows", "errors", "ok")


def _worklist(mode: str, sql_filter: str):
    @query(
        f"worklist_{mode}",
        f"WITH {_COURSES} SELECT name, year, slug, url FROM status WHERE {sql_filter}",
        BOTH,
    )
    def run(spark, d):
        return worklist(discovered(spark, d), view(spark, d, "submissions"), mode).select(*COLUMNS)


_worklist("missing", "NOT has_data")
_worklist("all", "true")
_worklist("retry", "has_data")


@query(
    "listing_urls",
    f"""WITH {_COURSES} SELECT slug, CAST(page AS INT) AS page,
 url || CASE WHEN page > 1 THEN '?page=' || page ELSE '' END AS page_url FROM courses, range(1, 4) r(page)""",
    BOTH,
)
def listing_urls(spark, d):
    return co.listing_urls(discovered(spark, d), BASE, 3).select("slug", "page", "page_url")


@query(
    "valid_types",
    """SELECT submission_id, CASE course WHEN 'course_a' THEN 'Batch, Streaming'
 ELSE 'Batch, Streaming, Web Service' END AS valid_types FROM submissions""",
    ("submissions",),
)
def valid_types(spark, d):
    typed = co.with_valid_types(
        view(spark, d, "submissions"), {"course_a": ["Batch", "Streaming"]}
    )
    return typed.select("submission_id", F.array_join("valid_types", ", ").alias("valid_types"))
