"""Whole jobs as queries: a model that answers by rule, asked within the plan, and no folder written."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.plans.enrichment import DirectAnswers, enrich_from_readme
from shelfmark.queries.enrich import _ASK_TITLES, _scores_sql, _sql_text, _titles_sql
from shelfmark.queries.registry import query
from shelfmark.queries.views import view

_DESCRIBE = "Describe purpose and key features of this repository in two sentences:\n"
TITLE_ANSWERS = (
    "1. Taxi Rides Storage Detection\n2. X",
    "1. X\n2. Y",
    None,
    "- Storage \"rides\": weekly view\n3. Smart System\n\n2. Title: Storage classifier",
)


def by_length(prompts):
    """A model whose answers follow from the length of the prompt alone, so that SQL can tell them."""
    out = []
    for p in prompts:
        n = len(p)
        if p.startswith("Describe"):
            out.append(None if n % 11 == 0 else f"taxi rides of kind {n % 5} with storage")
        else:
            out.append(TITLE_ANSWERS[n % len(TITLE_ANSWERS)])
    return out


def _answer_sql(n: str) -> str:
    cases = " ".join(f"WHEN {i} THEN {_sql_text(a)}" for i, a in enumerate(TITLE_ANSWERS) if a is not None)
    return f"CASE {n} % {len(TITLE_ANSWERS)} {cases} END"


def _ask_sql(subject: str, summary: str) -> str:
    return f"{_ASK_TITLES} || {_sql_text(chr(10) + 'Project URL: ')} || {subject} || {_sql_text(chr(10) + 'Project summary: ')} || {summary} || {_sql_text(chr(10) + 'Titles:')}"


_PROJECTS = """
projects AS (SELECT doc_id AS project_id, 'https://github.com/u/d' || doc_id || CASE doc_id % 4 WHEN 1 THEN '/tree/main/x' WHEN 2 THEN '.git/' ELSE '' END AS project_url,
 CASE doc_id % 5 WHEN 0 THEN 'Fraud Predictor "Detection"' WHEN 1 THEN 'Unknown' END AS project_title,
 CASE WHEN doc_id % 3 > 0 THEN content END AS content FROM readmes)"""


# Both requests for titles read alike, since no deployment type is known: a low score stays.
@query(
    "readme_titles",
    f"""WITH {_PROJECTS},
summed AS (SELECT *, length({_sql_text(_DESCRIBE)} || substring(content, 1, 3500)) AS n FROM projects WHERE project_title IS NULL AND length(content) > 0),
told AS (SELECT project_id, CASE WHEN n % 11 = 0 THEN '' ELSE 'taxi rides of kind ' || (n % 5) || ' with storage' END AS summary,
 CASE WHEN contains(project_url, '/tree/') THEN project_url ELSE 'u/d' || project_id END AS project_url FROM summed),
asked AS (SELECT *, {_answer_sql(f"length({_ask_sql('project_url', 'summary')})")} AS response FROM told),
{_titles_sql("asked", "response", "t").strip()}, {_scores_sql("t", "s").strip()},
best AS (SELECT project_id, title FROM s QUALIFY row_number() OVER (PARTITION BY project_id ORDER BY score DESC, i) = 1)
SELECT p.project_url, replace(replace(replace(replace(replace(coalesce(p.project_title, b.title, 'Unknown'), '"', ''), 'Title: ', ''),
 'Predictor', 'Prediction'), 'Detection', 'Prediction'), 'Classifier', 'Classification') AS project_title
FROM projects p LEFT JOIN best b USING (project_id)""",
    ("readmes",),
)
def readme_titles(spark, d):
    tail = F.when(F.col("doc_id") % 4 == 1, "/tree/main/x").when(F.col("doc_id") % 4 == 2, ".git/").otherwise("")
    url = F.concat(F.lit("https://github.com/u/d"), F.col("doc_id").cast("string"), tail)
    title = F.when(F.col("doc_id") % 5 == 0, 'Fraud Predictor "Detection"').when(F.col("doc_id") % 5 == 1, "Unknown")
    rows = view(spark, d, "readmes").select("doc_id", url.alias("project_url"), title.alias("project_title"), "content")
    catalogue = rows.select("project_url", "project_title")
    readmes = rows.where("doc_id % 3 > 0").select("project_url", "content")
    return enrich_from_readme(catalogue, readmes, DirectAnswers(by_length)).select("project_url", "project_title")
