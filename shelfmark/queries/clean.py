"""Queries over cleaning, URLs and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.functions import urls
from shelfmark.operators import clean as cl
from shelfmark.operators import pages as pg
from shelfmark.operators import urls as ur
from shelfmark.operators.repos import readme_of
from shelfmark.queries.registry import query
from shelfmark.queries.views import view

SUBS = ("submissions",)


def subs(spark, d):
    return view(spark, d, "submissions")


@query(
    "clean_dedup",
    "SELECT DISTINCT project_url FROM submissions WHERE project_url IS NOT NULL OR reason IS NOT NULL",
    SUBS,
)
def clean_dedup(spark, d):
    return cl.clean_and_deduplicate(subs(spark, d).select("project_url", "reason"))


@query(
    "combine_union",
    """
SELECT DISTINCT project_url, CASE WHEN course = 'course_a' THEN round(score, 2) END AS score,
 CASE WHEN course = 'course_b' THEN cloud END AS cloud,
 CASE WHEN course NOT IN ('course_a', 'course_b') THEN year END AS year
FROM submissions""",
    SUBS,
)
def combine_union(spark, d):
    rows = subs(spark, d).withColumn("score", F.round("score", 2))
    lists = [
        rows.where("course = 'course_a'").select("project_url", "score"),
        rows.where("course = 'course_b'").select("cloud", "project_url"),
        rows.where("course NOT IN ('course_a', 'course_b')").select("project_url", "year"),
    ]
    return cl.union_by_name(lists).distinct()


@query(
    "combine_keys",
    "SELECT DISTINCT project_url FROM submissions",
    SUBS,
)
def combine_keys(spark, d):
    rows = subs(spark, d)
    lists = [
        rows.where("course = 'course_a'").select("project_url", "score"),
        rows.where("course <> 'course_a'").select("year", "project_url"),
    ]
    return cl.clean_and_deduplicate(cl.union_by_name(lists))


@query(
    "na_tokens",
    "SELECT submission_id, CASE WHEN cloud IN ('', 'NA', 'N/A') THEN NULL ELSE cloud END AS cloud, "
    "reason FROM submissions",
    SUBS,
)
def na_tokens(spark, d):
    # Nulls written as the missing-value tokens a list may hold, then read back as null.
    texts = subs(spark, d).select(
        "submission_id",
        F.coalesce("cloud", F.lit("NaN")).alias("cloud"),
        F.coalesce("reason", F.lit("")).alias("reason"),
    )
    return cl.missing_to_null(texts)


@query(
    "update_titles",
    "SELECT submission_id, project_url, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS project_title "
    "FROM submissions JOIN orders ON o_orderkey = submission_id",
    SUBS,
)
def update_titles(spark, d):
    new = view(spark, d, "repo_projects").where("status_letter = 'F'").select("repo_id")
    orders = spark.read.parquet(f"{d.rstrip('/')}/orders.parquet")
    titles = new.join(orders, F.col("repo_id") == F.col("o_orderkey")).select(
        F.col("repo_id").alias("submission_id"), F.col("o_orderpriority").alias("project_title")
    )
    updated = cl.update_titles(subs(spark, d), titles, "submission_id")
    return updated.select("submission_id", "project_url", "project_title")


@query(
    "mojibake_fix",
    "SELECT submission_id, replace(project_title, 'SÃ£o', 'São') AS project_title, reason FROM submissions",
    SUBS,
)
def mojibake_fix(spark, d):
    return cl.repair_mojibake(subs(spark, d)).select("submission_id", "project_title", "reason")


@query(
    "clean_titles",
    "SELECT submission_id, replace(replace(project_title, '\"', ''), 'Title: ', '') AS project_title FROM submissions",
    SUBS,
)
def clean_titles(spark, d):
    return cl.clean_titles(subs(spark, d)).select("submission_id", "project_title")


@query(
    "normalise_titles",
    """
SELECT submission_id, replace(replace(replace(
 replace(replace(project_title, 'ring', 'Prediction'), 'widget', 'Prediction'), 'gear', 'Classification'),
 '"', ''), 'Title: ', '') AS project_title FROM submissions""",
    SUBS,
)
def normalise_titles(spark, d):
    title = F.col("project_title")
    for plain, term in (("ring", "Predictor"), ("widget", "Detection"), ("gear", "Classifier")):
        title = F.replace(title, F.lit(plain), F.lit(term))
    return cl.normalise_titles(subs(spark, d).select("submission_id", title.alias("project_title")))


# ---------------------------------------------------------------- URLs


@query(
    "url_valid",
    "SELECT submission_id, coalesce(regexp_matches(project_url, '^https://github\\.com/[^?#;]'), false) AS valid "
    "FROM submissions",
    SUBS,
)
def url_valid(spark, d):
    return subs(spark, d).select(
        "submission_id", urls.is_project_url(F.col("project_url")).alias("valid")
    )


_PARSED = """
cut AS (SELECT submission_id, rtrim(regexp_replace(trim(project_url), '[?#].*$', ''), '/') AS u FROM submissions),
split AS (SELECT submission_id, regexp_replace(regexp_replace(u, '/(tree|blob)/.*$', ''), '\\.git$', '') AS base,
 regexp_extract(u, '/(?:tree|blob)/([^/]*)', 1) AS branch,
 regexp_extract(u, '/tree/[^/]*/(.*)$', 1) AS subpath FROM cut),
named AS (SELECT *, string_split(replace(base, 'https://github.com/', ''), '/') AS parts FROM split),
parsed AS (SELECT submission_id, len(parts) >= 2 AND parts[1] <> '' AND parts[2] <> '' AS ok,
 parts, branch, subpath FROM named)"""


@query(
    "url_parse",
    f"""WITH {_PARSED}
SELECT submission_id, CASE WHEN ok THEN parts[1] END AS owner, CASE WHEN ok THEN parts[2] END AS repo,
 CASE WHEN ok AND subpath <> '' THEN url_decode(subpath) END AS subpath,
 CASE WHEN ok AND branch <> '' THEN branch END AS branch FROM parsed""",
    SUBS,
)
def url_parse(spark, d):
    parsed = ur.parse_repo_url(subs(spark, d))
    return parsed.select("submission_id", "owner", "repo", "subpath", "branch")


@query(
    "url_sanitize",
    "SELECT submission_id, regexp_replace(project_url, '[?#].*$', '') AS url FROM submissions",
    SUBS,
)
def url_sanitize(spark, d):
    return subs(spark, d).select("submission_id", urls.sanitized(F.col("project_url")).alias("url"))


_LOCATED = """
located AS (SELECT submission_id, u, string_split(string_split(u, 'github.com/')[-1], '/') AS parts
 FROM (SELECT submission_id, regexp_replace(project_url, '[?#].*$', '') AS u FROM submissions)
 WHERE contains(u, 'github.com/')),
folded AS (SELECT submission_id, parts[1] AS owner, replace(parts[2], '.git', '') AS repo,
 list_contains(parts, 'README.md') AS direct,
 CASE WHEN parts[3] IN ('tree', 'blob') THEN parts[4] END AS branch,
 array_to_string(CASE WHEN parts[3] IN ('tree', 'blob') THEN parts[5:] ELSE parts[3:] END, '/') AS folder
 FROM located)"""


@query(
    "readme_paths",
    f"""WITH {_LOCATED}
SELECT s.submission_id, owner, repo, CASE WHEN NOT direct THEN branch END AS branch,
 CASE WHEN NOT direct THEN folder END AS folder, direct,
 CASE WHEN direct THEN 'README.md' WHEN folder = '' THEN 'README.md' WHEN folder IS NOT NULL THEN folder || '/README.md' END AS path
FROM submissions s LEFT JOIN folded USING (submission_id)""",
    SUBS,
)
def readme_paths(spark, d):
    located = ur.locate_readmes(subs(spark, d).withColumn("readme_name", F.lit("README.md")))
    named = ur.readme_candidates(located)
    return named.select("submission_id", "owner", "repo", "branch", "folder", "direct", "path")


_REQUESTED = f"""WITH {_LOCATED},
slugged AS (SELECT submission_id, project_url, string_split(rtrim(regexp_replace(
 string_split(project_url, 'github.com/')[-1], '\\.git$', ''), '/'), '/') AS s FROM submissions)
SELECT submission_id, CASE WHEN contains(project_url, '/tree/') THEN owner ELSE s[1] END AS owner,
 CASE WHEN contains(project_url, '/tree/') THEN repo ELSE s[2] END AS repo,
 CASE WHEN contains(project_url, '/tree/') THEN folder END AS folder
FROM slugged LEFT JOIN folded USING (submission_id)"""


@query("readme_requests", _REQUESTED, SUBS)
def readme_requests(spark, d):
    return ur.readme_requests(subs(spark, d)).select("submission_id", "owner", "repo", "folder")


@query(
    "readme_slug",
    "SELECT submission_id, rtrim(regexp_replace(string_split(project_url, 'github.com/')[-1], '\\.git$', ''), '/') AS slug "
    "FROM submissions",
    SUBS,
)
def readme_slug(spark, d):
    return subs(spark, d).select("submission_id", urls.readme_slug(F.col("project_url")).alias("slug"))


@query(
    "readme_lookup",
    """
SELECT p.repo_id, p.folder, min(name) AS readme_name FROM (
 SELECT repo_id, CASE WHEN repo_id % 2 = 0 THEN '' ELSE 'src' END AS folder FROM repo_projects) p
LEFT JOIN (SELECT repo_id, CASE WHEN contains(path, '/') THEN regexp_replace(path, '/[^/]*$', '') ELSE '' END AS folder,
  regexp_replace(path, '^.*/', '') AS name FROM repo_files
  WHERE type = 'blob' AND regexp_matches(path, '(?i)(^|/)readme\\.md$')) e
 ON p.repo_id = e.repo_id AND p.folder = e.folder
GROUP BY p.repo_id, p.folder""",
    ("repo_projects", "repo_files"),
)
def readme_lookup(spark, d):
    files = view(spark, d, "repo_files")
    name = F.substring_index("path", "/", -1)
    folder = F.when(
        F.col("path").contains("/"),
        F.substring("path", F.lit(1), F.length("path") - F.length(name) - 1),
    ).otherwise("")
    entries = files.select(
        "repo_id",
        folder.alias("folder"),
        F.col("path").alias("position"),
        name.alias("name"),
        F.when(F.col("type") == "blob", "file").otherwise("dir").alias("type"),
    )
    projects = view(spark, d, "repo_projects").select(
        "repo_id", F.when(F.col("repo_id") % 2 == 0, "").otherwise("src").alias("folder")
    )
    return readme_of(projects, entries, ["repo_id"])


# ---------------------------------------------------------------- pages

_LINKS = """
links AS (SELECT series_id, page, html,
 regexp_extract(html, 'href="(https://github\\.com/[^"?#;][^"]*)"', 1) AS project_url,
 trim(regexp_extract(html, '<span>([^<]*)</span>', 1)) AS score,
 contains(html, 'aria-label="Next page"') AS has_next FROM listing_pages)"""
LISTING = ("listing_pages",)


@query(
    "listing_extract",
    f"WITH {_LINKS} SELECT series_id, page, project_url, score, has_next FROM links WHERE project_url <> ''",
    LISTING,
)
def listing_extract(spark, d):
    links = pg.page_links(view(spark, d, "listing_pages"))
    flat = links.select("series_id", "page", "has_next", F.inline_outer("links"))
    found = flat.where(F.col("project_url").isNotNull())
    return found.select("series_id", "page", "project_url", "score", "has_next")


_REACHED = f"""{_LINKS},
reached AS (SELECT l.* FROM links l LEFT JOIN (
  SELECT series_id, min(page) AS stop FROM links WHERE NOT has_next OR project_url = '' GROUP BY 1) s
 USING (series_id) WHERE page <= 100 AND (stop IS NULL OR page <= stop))"""


@query("listing_stop", f"WITH {_REACHED} SELECT series_id, page FROM reached", LISTING)
def listing_stop(spark, d):
    return pg.stop_paging(pg.page_links(view(spark, d, "listing_pages"))).select("series_id", "page")


@query(
    "listing_dedup",
    f"""WITH {_REACHED}
SELECT series_id, project_url, score FROM reached WHERE project_url <> ''
QUALIFY row_number() OVER (PARTITION BY series_id, project_url ORDER BY page) = 1""",
    LISTING,
)
def listing_dedup(spark, d):
    return pg.scraped(view(spark, d, "listing_pages"))


@query(
    "listing_nested",
    """WITH planted AS (SELECT submission_id, project_url, submission_id % 6 AS kind FROM submissions
 WHERE regexp_matches(project_url, '^https://github\\.com/[^?#;]')),
score AS (SELECT * FROM (VALUES (0, '34'), (0, '34'), (2, ''), (2, ''), (3, '5 < 6'), (5, ''), (5, '')) s(kind, score))
SELECT submission_id, project_url, score FROM planted JOIN score USING (kind)""",
    ("submissions",),
)
def listing_nested(spark, d):
    pages = view(spark, d, "nested_pages").select(
        F.col("submission_id").alias("series_id"), F.lit(1).alias("page"), "html"
    )
    found = pg.link_rows(pg.page_links(pages))
    return found.select(F.col("series_id").alias("submission_id"), "project_url", "score")


@query(
    "listing_states",
    f"""WITH RECURSIVE {_LINKS.strip().replace("listing_pages", "listing_holes")},
reach AS (SELECT series_id, page, project_url, has_next FROM links WHERE page = 1
 UNION ALL SELECT l.series_id, l.page, l.project_url, l.has_next FROM reach r JOIN links l ON l.series_id = r.series_id AND l.page = r.page + 1
 WHERE r.has_next AND r.project_url <> '' AND l.page <= 100),
read AS (SELECT series_id, count(*) AS pages, count_if(project_url <> '') AS links, max(page) AS last,
 bool_or(NOT has_next OR project_url = '' OR page = 100) AS ended FROM reach GROUP BY series_id)
SELECT series_id, CASE WHEN r.pages IS NULL THEN 'missing' WHEN NOT ended THEN 'incomplete' WHEN links = 0 THEN 'empty' ELSE 'complete' END AS status,
 CAST(coalesce(r.pages, 0) AS BIGINT) AS pages, CAST(coalesce(links, 0) AS BIGINT) AS links, CAST(n - coalesce(r.pages, 0) AS BIGINT) AS beyond
FROM (SELECT series_id, count(*) AS n FROM links WHERE page <= 100 GROUP BY series_id) a LEFT JOIN read r USING (series_id)""",
    ("listing_holes",),
)
def listing_states(spark, d):
    return pg.series_states(pg.page_links(view(spark, d, "listing_holes")))


@query(
    "archive_section",
    """
SELECT link_id AS page_id, CAST(pos AS INT) AS pos,
 CASE WHEN link_id % 3 = 0 THEN '/now' || href WHEN pos = 0 THEN href ELSE '/two' || href END AS href
FROM home_links, range(0, 2) r(pos) WHERE link_id % 3 <> 0 OR pos = 0""",
    ("home_links",),
)
def archive_section(spark, d):
    return pg.archive_links(view(spark, d, "home_pages"))
