"""Inputs of the registered queries, derived from the given tables.

Each view is one SQL text that runs unchanged in Spark and in DuckDB, so a
query and its check start from the same rows. Spark reads the parquet files
through CTEs, hence no temporary views are left behind in the session.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession

BASE = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

VIEWS = {
    "submissions": """
SELECT o_orderkey AS submission_id, o_custkey AS author_id,
 CASE o_custkey % 4 WHEN 0 THEN 'course_a' WHEN 1 THEN 'course_b' WHEN 2 THEN 'course_c' ELSE 'course_d' END AS course,
 CAST(year(o_orderdate) AS STRING) AS year,
 CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE concat(
  CASE o_orderkey % 11 WHEN 0 THEN 'http://github.com/' WHEN 1 THEN 'https://gitlab.com/' ELSE 'https://github.com/' END,
  'user', CAST(o_custkey AS STRING), '/repo', CAST(o_orderkey % 3 AS STRING),
  CASE o_orderkey % 7 WHEN 0 THEN '/' WHEN 1 THEN '.git' WHEN 2 THEN '/tree/main/Proj%202' WHEN 3 THEN '/blob/main/README.md' WHEN 4 THEN '?tab=readme#top' ELSE '' END) END AS project_url,
 CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'Unknown' WHEN o_orderkey % 19 = 0 THEN 'Error' WHEN o_orderkey % 23 = 0 THEN concat('Title: "SÃ£o ', p_name, '"') ELSE concat(p_name, ' ', p_type) END AS project_title,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'Streaming' WHEN '2-HIGH' THEN 'Batch' WHEN '3-MEDIUM' THEN 'Web Service' WHEN '4-NOT SPECIFIED' THEN 'Unknown' ELSE 'Batch, Streaming' END AS deployment_type,
 CASE o_orderkey % 10 WHEN 0 THEN '404: Repository not found' WHEN 1 THEN 'No files fetched' WHEN 2 THEN NULL ELSE concat('keyword ', o_orderstatus) END AS reason,
 CASE c_mktsegment WHEN 'MACHINERY' THEN 'AWS' WHEN 'FURNITURE' THEN 'GCP' WHEN 'BUILDING' THEN 'Azure' WHEN 'AUTOMOBILE' THEN 'Unknown' ELSE NULL END AS cloud,
 o_totalprice AS score
FROM (SELECT *, o_orderkey % (SELECT count(*) FROM part) AS o_partkey FROM orders) o
JOIN customer ON o_custkey = c_custkey JOIN part ON p_partkey = o_partkey""",
    "readmes": """
SELECT doc_id, lower(concat(text, ' ', CASE doc_id % 6 WHEN 0 THEN 'Apache Spark on AWS EC2' WHEN 1 THEN 'fastapi, Google Cloud Run' WHEN 2 THEN 'kafka real-time Azure' WHEN 3 THEN 'Batch Flask GCP AWS' WHEN 4 THEN 'streamlit app' ELSE '' END)) AS content FROM documents""",
    # One repository in eight holds the files of its neighbours too: more key files than are fetched.
    "repo_files": """
SELECT DISTINCT repo_id, concat(
 CASE l_linenumber % 4 WHEN 0 THEN '' WHEN 1 THEN 'src/' WHEN 2 THEN 'dags/etl/' ELSE 'x/node_modules/' END,
 CASE l_suppkey % 8 WHEN 0 THEN 'README.md' WHEN 1 THEN 'Dockerfile' WHEN 2 THEN concat('main', CAST(l_partkey % 20 AS STRING), '.tf') WHEN 3 THEN 'img.png' WHEN 4 THEN concat('kafka_job', CAST(l_partkey % 40 AS STRING), '.py') WHEN 5 THEN 'requirements.txt' WHEN 6 THEN 'data.csv' ELSE 'util.py' END) AS path,
 CASE WHEN l_partkey % 5 = 0 THEN 'tree' ELSE 'blob' END AS type,
 CASE repo_id % 3 WHEN 0 THEN 'main' WHEN 1 THEN 'master' ELSE 'develop' END AS branch
FROM (SELECT *, l_orderkey AS repo_id FROM lineitem UNION ALL SELECT *, l_orderkey - l_orderkey % 8 AS repo_id FROM lineitem) l""",
    # Some texts are landed without a ref, some several times: the last landing counts.
    "file_contents": """
SELECT repo_id, path, CASE WHEN repo_id % 4 < 2 AND length(path) % 3 > 0 THEN NULL ELSE branch END AS ref, landed_at,
 CASE WHEN landed_at = 2 THEN concat(text, ' again') ELSE text END AS content
FROM (SELECT *, (repo_id * 7 + length(path)) % (SELECT count(*) FROM documents) AS text_id
 FROM (SELECT DISTINCT repo_id, path, branch, 1 AS landed_at FROM repo_files WHERE type = 'blob'
  UNION ALL SELECT DISTINCT repo_id, path, branch, 2 AS landed_at FROM repo_files WHERE type = 'blob' AND repo_id % 9 = 0) b) f
JOIN documents ON doc_id = text_id""",
    # No row for one repository in four, two rows for one in ten.
    "repo_status": """
SELECT o_orderkey AS repo_id, n AS landed_at, CASE WHEN o_orderpriority = '1-URGENT' THEN 404 ELSE 200 END AS status_code,
 CASE WHEN n = 2 THEN 'develop' ELSE CASE o_orderpriority WHEN '2-HIGH' THEN 'develop' WHEN '3-MEDIUM' THEN NULL ELSE 'main' END END AS default_branch
FROM (SELECT *, 1 AS n FROM orders UNION ALL SELECT *, 2 AS n FROM orders WHERE o_orderkey % 10 = 0) o
WHERE o_orderkey % 4 <> 1""",
    "repo_projects": """
SELECT o_orderkey AS repo_id, o_orderstatus AS status_letter,
 CASE o_orderstatus WHEN 'P' THEN 'develop' WHEN 'F' THEN 'gone' ELSE NULL END AS branch,
 CASE o_orderkey % 5 WHEN 0 THEN 'src' WHEN 1 THEN 'DAGS/etl' WHEN 2 THEN 'dockerfile' WHEN 3 THEN '' ELSE NULL END AS subpath
FROM orders""",
    "model_answers": """
SELECT event_id, user_id, concat('DEPLOYMENT: ', CASE event_type WHEN 'signup' THEN 'Batch' WHEN 'error' THEN 'n/a' WHEN 'click' THEN 'batch, STREAMING' WHEN 'view' THEN 'Web API' ELSE 'Streamlit' END, chr(10), 'DEPLOYMENT_REASON: user ', CAST(user_id AS STRING), chr(10), '  CLOUD: ', CASE user_id % 5 WHEN 0 THEN 'Google Cloud' WHEN 1 THEN 'Amazon' WHEN 2 THEN 'azure' WHEN 3 THEN 'Unknown' ELSE 'Hetzner' END, chr(10), 'CLOUD_REASON: props') AS response FROM events""",
    "title_responses": """
SELECT p_partkey AS project_id, concat('https://github.com/u/', replace(p_name, ' ', '-')) AS project_url, concat('a ', lower(p_type), ' ', p_name, ' dashboard with storage') AS summary,
 concat('1. ', p_name, ' sales pipeline', chr(10), '2. Smart ', p_type, ' System', chr(10), chr(10), '- ', p_name, ': daily view', chr(10), '3. Cloud storage', chr(10), '1. ', p_name, ' sales pipeline') AS response FROM part""",
    "listing_pages": """
SELECT author_id AS series_id, CAST(row_number() OVER (PARTITION BY author_id ORDER BY submission_id) AS INT) AS page,
 concat(CASE WHEN project_url IS NULL THEN '<p>none</p>' WHEN submission_id % 5 = 0 THEN concat('<table><tr><td><a href="', project_url, '">p</a></td></tr></table>')
  ELSE concat('<article><a href="', project_url, '">p</a>', CASE WHEN submission_id % 3 = 0 THEN '' ELSE concat('<span> ', CAST(submission_id % 36 AS STRING), ' </span>') END, '</article>') END,
  CASE WHEN submission_id % 9 = 0 THEN '' ELSE '<a aria-label="Next page" href="?page=2">n</a>' END) AS html FROM submissions""",
    # Some pages of a series are not there, first ones too.
    "listing_holes": """
SELECT * FROM listing_pages WHERE (series_id * 7 + page * 3) % 13 <> 0""",
    # Articles in articles, tables in tables, cells outside of tables, comments, entities and end tags left out.
    "nested_pages": """
SELECT submission_id, project_url,
 CASE WHEN project_url IS NULL THEN '<p>none</p>' ELSE CASE submission_id % 6
  WHEN 0 THEN concat('<article><div><article><span class="s"> <b> 3 </b> <i> 4 </i> </span><a href="', project_url, '">x</a></article></div><span>7</span></article>')
  WHEN 1 THEN concat('<td><a href="', project_url, '">p</a></td><tr><th><a href="', project_url, '">p</a></th></tr>')
  WHEN 2 THEN concat('<table><tr><td><table><tr><td><a href="', project_url, '">p</a></td></tr></table></td><th>no</th></tr></table>')
  WHEN 3 THEN concat('<article data-x="a > b" ><a class="l" href="', replace(project_url, '://', ':&#x2F;&#47;'), '">p</a><span> 5 &lt; 6 </span></article>')
  WHEN 4 THEN concat('<!-- <article><a href="', project_url, '">old</a></article> --><article><p>none</p></article>')
  ELSE concat('<table><tr><td>a<td><a href=', project_url, '>p</a></tr></table><td><a href="', project_url, '">p</a>') END END AS html
FROM submissions""",
    "home_links": """
SELECT s_suppkey AS link_id, concat('/', CASE s_suppkey % 5 WHEN 0 THEN 'de-track' WHEN 1 THEN 'ml-track' WHEN 2 THEN 'llm-track' WHEN 3 THEN 'other' ELSE 'De' END, '-', CAST(1990 + s_nationkey % 12 AS STRING), CASE WHEN s_suppkey % 2 = 0 THEN '/' ELSE '' END) AS href FROM supplier""",
    "home_pages": """
SELECT link_id AS page_id, concat('<section><h2>Active</h2><a href="/now', href, '">n</a></section>',
 CASE WHEN link_id % 3 = 0 THEN '' ELSE concat('<section class="x"><h2><b>Course Archive</b></h2><ul><li><a href="', href, '">a</a></li><li><a class="l" href="/two', href, '">b</a></li></ul></section>') END) AS html FROM home_links""",
    "lemmas": """
SELECT DISTINCT lower(p_type) AS form, substring(lower(p_type), 1, 4) AS lemma FROM part""",
}


@cache
def _needs(name: str) -> tuple[str, ...]:
    """Views a view reads, before it."""
    found: dict[str, None] = {}
    for other in VIEWS:
        if other != name and re.search(rf"\b(?:FROM|JOIN) {other}\b", VIEWS[name]):
            found.update(dict.fromkeys([*_needs(other), other]))
    return tuple(found)


def ctes(*names: str) -> list[str]:
    ordered: dict[str, None] = {}
    for name in names:
        ordered.update(dict.fromkeys([*_needs(name), name]))
    return [f"{name} AS ({VIEWS[name].strip()})" for name in ordered]


def with_views(sql: str, *names: str) -> str:
    """A check in SQL with the views it reads written in front of it."""
    own = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", sql)
    parts = ctes(*names)
    if own:
        return f"WITH {own.group(1) or ''}{', '.join(parts)}, {sql[own.end():]}" if parts else sql
    return f"WITH {', '.join(parts)} {sql}" if parts else sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    folder = sf_dir.rstrip("/")
    text = " ".join(ctes(name))
    base = [
        f"{b} AS (SELECT * FROM parquet.`{folder}/{b}.parquet`)"
        for b in BASE
        if re.search(rf"\b{b}\b", text)
    ]
    return spark.sql(f"WITH {', '.join([*base, *ctes(name)])} SELECT * FROM {name}")
