"""Queries over the exploration operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.functions.text import PUNCTUATION, STOP_WORDS
from shelfmark.operators import explore as ex
from shelfmark.queries.registry import query
from shelfmark.queries.views import table, view
from shelfmark.sources.catalogue import select_partitions, years

COURSES = ("course_a", "course_b", "course_c", "course_d")
SUBS = ("submissions",)
NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_PUNCT = PUNCTUATION.replace("'", "''")
# One row per content word of a title, with its position.
WORDS_SQL = f"""
words AS (
 SELECT submission_id, i AS pos, w FROM (
  SELECT submission_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (
   SELECT submission_id, string_split_regex(translate(lower(coalesce(project_title, 'nan')), '{_PUNCT}', ''), '\\s+') AS ws
   FROM submissions))
 WHERE w <> '' AND w NOT IN ({_STOP}))"""


def subs(spark, d):
    return view(spark, d, "submissions")


@query(
    "load_partitions",
    "SELECT submission_id, course, year, project_url FROM submissions "
    "WHERE course IN ('course_a', 'course_c') AND year IN ('1995', '1996', '1998')",
    SUBS,
)
def load_partitions(spark, d):
    chosen = select_partitions(subs(spark, d), ["course_a", "course_c"], [1995, 1996, 1998])
    return chosen.select("submission_id", "course", "year", "project_url")


@query("available_years", "SELECT DISTINCT year FROM submissions WHERE regexp_matches(year, '^\\d+$')", SUBS)
def available_years(spark, d):
    return years(subs(spark, d))


_TITLED = "SELECT submission_id, project_title FROM submissions WHERE "


@query("hide_unknown", _TITLED + "project_title IS DISTINCT FROM 'Unknown'", SUBS)
def hide_unknown(spark, d):
    return ex.hide_unknown(subs(spark, d)).select("submission_id", "project_title")


@query("only_unknown", _TITLED + "project_title = 'Unknown'", SUBS)
def only_unknown(spark, d):
    return ex.only_unknown(subs(spark, d)).select("submission_id", "project_title")


_CHAIN = """
SELECT submission_id, project_title, deployment_type, cloud, round(score, 2) AS score
FROM submissions
WHERE project_title IS DISTINCT FROM 'Unknown' AND deployment_type IN ('Batch', 'Streaming')
 AND (cloud = 'AWS' OR cloud IS NULL) AND score BETWEEN 100000 AND 400000
 AND coalesce(regexp_matches(project_title, '(?i)r[aiou]|WIDGET'), false)"""
_CHAIN_COLUMNS = ("submission_id", "project_title", "deployment_type", "cloud")


@query("filter_chain", _CHAIN, SUBS)
def filter_chain(spark, d):
    specs = {
        "project_title": "r[aiou]|WIDGET",
        "deployment_type": ["Batch", "Streaming"],
        "cloud": ["AWS", None],
        "score": (100000.0, 400000.0),
    }
    kept = ex.filter_chain(subs(spark, d), specs)
    return kept.select(*_CHAIN_COLUMNS, F.round("score", 2).alias("score"))


@query("filter_by_kind", _CHAIN, SUBS)
def filter_by_kind(spark, d):
    kept = ex.where(
        ex.hide_unknown(subs(spark, d)),
        project_title=ex.Matches("r[aiou]|WIDGET"),
        deployment_type=ex.OneOf(["Batch", "Streaming"]),
        cloud=ex.OneOf(["AWS", None]),
        score=ex.InRange(100000.0, 400000.0),
    )
    return kept.select(*_CHAIN_COLUMNS, F.round("score", 2).alias("score"))


@query(
    "range_bounds",
    "SELECT min(score) AS low, max(score) AS high, round((max(score) - min(score)) / 100, 6) AS step FROM submissions",
    SUBS,
)
def range_bounds(spark, d):
    bounds = ex.range_bounds(subs(spark, d), "score")
    return bounds.withColumn("step", F.round("step", 6))


def _profile_sql(c: str) -> str:
    return (
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct, "
        f"CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max FROM submissions"
    )


_PROFILED = ("author_id", "course", "year", "project_url", "cloud")


@query("column_profile", " UNION ALL ".join(map(_profile_sql, _PROFILED)), SUBS)
def column_profile(spark, d):
    return ex.profile(subs(spark, d), _PROFILED)


def _counts_sql(col: str, limit: str = "", source: str = "submissions") -> str:
    return (
        f"SELECT {col}, count(*) AS n FROM {source} WHERE {col} IS NOT NULL GROUP BY {col} "
        f"ORDER BY n DESC, {col} {limit}"
    )


@query(
    "top_titles",
    "WITH shown AS (SELECT coalesce(project_title, 'nan') AS project_title FROM submissions "
    "WHERE project_title IS DISTINCT FROM 'Unknown') "
    + _counts_sql("project_title", "LIMIT 10", "shown"),
    SUBS,
)
def top_titles(spark, d):
    return ex.counts(ex.hide_unknown(ex.with_text_titles(subs(spark, d))), "project_title", 10)


@query("course_counts", _counts_sql("course"), SUBS)
def course_counts(spark, d):
    return ex.counts(subs(spark, d), "course")


@query("deployment_counts", _counts_sql("deployment_type"), SUBS)
def deployment_counts(spark, d):
    return ex.counts(subs(spark, d), "deployment_type")


@query("cloud_counts", _counts_sql("cloud"), SUBS)
def cloud_counts(spark, d):
    return ex.counts(subs(spark, d), "cloud")


@query(
    "course_share",
    "SELECT course, count(*) AS n, round(count(*) / (SELECT count(course) FROM submissions), 6) AS share "
    "FROM submissions WHERE course IS NOT NULL GROUP BY course",
    SUBS,
)
def course_share(spark, d):
    return ex.shares(subs(spark, d), "course").withColumn("share", F.round("share", 6))


@query(
    "title_words",
    f"WITH {WORDS_SQL} SELECT s.submission_id, coalesce(string_agg(w, ' ' ORDER BY pos), '') AS words "
    "FROM submissions s LEFT JOIN words USING (submission_id) GROUP BY s.submission_id",
    SUBS,
)
def title_words(spark, d):
    processed = ex.preprocess(ex.with_text_titles(subs(spark, d)))
    return processed.select(
        "submission_id", F.array_join("processed_titles", " ").alias("words")
    )


@query(
    "title_lemmas",
    f"WITH {WORDS_SQL} SELECT s.submission_id, coalesce(string_agg(coalesce(lemma, w), ' ' ORDER BY pos), '') AS words "
    "FROM submissions s LEFT JOIN words USING (submission_id) LEFT JOIN lemmas ON form = w "
    "GROUP BY s.submission_id",
    ("submissions", "lemmas"),
)
def title_lemmas(spark, d):
    titled = ex.with_text_titles(subs(spark, d))
    processed = ex.preprocess(titled, lemmas=view(spark, d, "lemmas"), key="submission_id")
    return processed.select("submission_id", F.array_join("processed_titles", " ").alias("words"))


_WORD_COUNTS = (
    f"{WORDS_SQL}, counted AS (SELECT coalesce(lemma, w) AS word, count(*) AS n FROM words "
    "LEFT JOIN lemmas ON form = w WHERE submission_id IN "
    "(SELECT submission_id FROM submissions WHERE project_title IS DISTINCT FROM 'Unknown') GROUP BY 1)"
)


@query(
    "top_words",
    f"WITH {_WORD_COUNTS} SELECT word, n FROM counted ORDER BY n DESC, word LIMIT 10",
    ("submissions", "lemmas"),
)
def top_words(spark, d):
    processed = ex.preprocess(ex.hide_unknown(ex.with_text_titles(subs(spark, d))))
    return ex.word_counts(processed, lemmas=view(spark, d, "lemmas"), n=10)


@query(
    "term_weights",
    f"WITH {_WORD_COUNTS} SELECT word, n, round(n / (SELECT max(n) FROM counted), 6) AS weight "
    "FROM counted ORDER BY n DESC, word LIMIT 100",
    ("submissions", "lemmas"),
)
def term_weights(spark, d):
    processed = ex.preprocess(ex.hide_unknown(ex.with_text_titles(subs(spark, d))))
    weights = ex.term_weights(processed, lemmas=view(spark, d, "lemmas"))
    return weights.withColumn("weight", F.round("weight", 6))


def _pivot_sql(row: str) -> str:
    cells = ", ".join(f"count(*) FILTER (course = '{c}') AS {c}" for c in COURSES)
    return f"SELECT {row}, {cells} FROM submissions WHERE {row} IS NOT NULL GROUP BY {row}"


@query("pivot_year_course", _pivot_sql("year"), SUBS)
def pivot_year_course(spark, d):
    return ex.count_pivot(subs(spark, d), "year", "course", COURSES)


@query("pivot_cloud_course", _pivot_sql("cloud"), SUBS)
def pivot_cloud_course(spark, d):
    return ex.count_pivot(subs(spark, d), "cloud", "course", COURSES)


@query("pivot_deployment_course", _pivot_sql("deployment_type"), SUBS)
def pivot_deployment_course(spark, d):
    return ex.count_pivot(subs(spark, d), "deployment_type", "course", COURSES)


@query(
    "pivot_totals",
    _pivot_sql("year").replace(" FROM", ", count(course) AS total FROM"),
    SUBS,
)
def pivot_totals(spark, d):
    return ex.pivot_totals(ex.count_pivot(subs(spark, d), "year", "course", COURSES), "year")


@query(
    "pair_counts",
    "SELECT year, course, count(*) AS n FROM submissions GROUP BY year, course",
    SUBS,
)
def pair_counts(spark, d):
    return ex.pair_counts(subs(spark, d), "year", "course")


@query(
    "stacked_base",
    """
WITH parts AS (SELECT deployment_type, course, count(*) AS n FROM submissions
  WHERE deployment_type IS NOT NULL AND course IS NOT NULL GROUP BY ALL),
 sizes AS (SELECT course, sum(n) AS size FROM parts GROUP BY course)
SELECT deployment_type, course, n,
 CAST(coalesce(sum(n) OVER (PARTITION BY deployment_type ORDER BY size DESC, course
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS base,
 CAST(sum(n) OVER (PARTITION BY deployment_type) AS BIGINT) AS total
FROM parts JOIN sizes USING (course)""",
    SUBS,
)
def stacked_base(spark, d):
    return ex.stacked(subs(spark, d), "deployment_type", "course")


@query(
    "histogram",
    """
WITH b AS (SELECT min(l_extendedprice) AS low, max(l_extendedprice) AS high,
  (max(l_extendedprice) - min(l_extendedprice)) / 20 AS width FROM lineitem),
 filled AS (SELECT CAST(least(floor((l_extendedprice - low) / width) + 1, 20) AS INT) AS bin, count(*) AS n
  FROM lineitem, b GROUP BY 1)
SELECT CAST(i AS INT) AS bin, round(low + (i - 1) * width, 4) AS low, round(low + i * width, 4) AS high,
 coalesce(n, 0) AS n
FROM range(1, 21) r(i) CROSS JOIN b LEFT JOIN filled ON filled.bin = i""",
)
def histogram(spark, d):
    bars = ex.histogram(table(spark, d, "lineitem"), "l_extendedprice", 20)
    return bars.withColumns({"low": F.round("low", 4), "high": F.round("high", 4)})


@query(
    "text_histogram",
    "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY 1",
)
def text_histogram(spark, d):
    return ex.histogram(table(spark, d, "lineitem"), "l_returnflag")


@query(
    "correlation",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS r FROM lineitem"
        for a in NUMBERS
        for b in NUMBERS
    ),
)
def correlation(spark, d):
    pairs = ex.correlations(table(spark, d, "lineitem"), NUMBERS)
    return pairs.withColumn("r", F.round("r", 6) + F.lit(0.0))


@query("row_count", "SELECT count(*) AS n FROM submissions WHERE project_title IS DISTINCT FROM 'Unknown'", SUBS)
def row_count(spark, d):
    return ex.hide_unknown(subs(spark, d)).agg(F.count(F.lit(1)).alias("n"))
