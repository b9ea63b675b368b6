"""Queries over model answers, titles and the states of catalogue rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.functions import answers as fa
from shelfmark.functions.titles import GENERIC_TERMS, GENERIC_WORDS
from shelfmark.operators import answers as an
from shelfmark.operators import clean as cl
from shelfmark.operators import enrich as en
from shelfmark.operators import titles as ti
from shelfmark.operators.courses import with_valid_types
from shelfmark.queries.registry import query
from shelfmark.queries.views import view

SUBS = ("submissions",)
TYPES = {"course_a": ["Batch", "Streaming"]}
RESULTS = cl.RESULT_COLUMNS


def subs(spark, d):
    return view(spark, d, "submissions")


# ---------------------------------------------------------------- answers

_LINES = """
lines AS (SELECT event_id, user_id, list_transform(string_split(trim(response), chr(10)), lambda x: trim(x)) AS ls FROM model_answers),
fields AS (SELECT event_id, user_id,
 trim(replace(list_filter(ls, lambda x: starts_with(x, 'DEPLOYMENT:'))[-1], 'DEPLOYMENT:', '')) AS d,
 trim(replace(list_filter(ls, lambda x: starts_with(x, 'DEPLOYMENT_REASON:'))[-1], 'DEPLOYMENT_REASON:', '')) AS dr,
 trim(replace(list_filter(ls, lambda x: starts_with(x, 'CLOUD:'))[-1], 'CLOUD:', '')) AS c,
 trim(replace(list_filter(ls, lambda x: starts_with(x, 'CLOUD_REASON:'))[-1], 'CLOUD_REASON:', '')) AS cr FROM lines),
parsed AS (SELECT event_id, user_id, coalesce(nullif(concat_ws(', ', CASE WHEN contains(lower(d), 'batch') THEN 'Batch' END,
  CASE WHEN contains(lower(d), 'stream') THEN 'Streaming' END,
  CASE WHEN contains(lower(d), 'web') OR contains(lower(d), 'service') THEN 'Web Service' END), ''), 'Unknown') AS deployment_type,
 coalesce(dr, 'Unknown') AS deployment_reason,
 CASE WHEN regexp_matches(lower(c), 'gcp|google') THEN 'GCP' WHEN regexp_matches(lower(c), 'aws|amazon') THEN 'AWS'
  WHEN contains(lower(c), 'azure') THEN 'Azure' WHEN contains(lower(c), 'unknown') THEN 'Unknown' ELSE coalesce(c, 'Unknown') END AS cloud_provider,
 coalesce(cr, 'Unknown') AS cloud_reason FROM fields)"""
ANSWERS = ("model_answers",)
ANSWER_FIELDS = ("deployment_type", "deployment_reason", "cloud_provider", "cloud_reason")


def parsed(spark, d):
    return an.parse_answers(view(spark, d, "model_answers"))


@query(
    "answer_parse",
    f"WITH {_LINES} SELECT event_id, deployment_type, deployment_reason, cloud_provider, cloud_reason FROM parsed",
    ANSWERS,
)
def answer_parse(spark, d):
    return parsed(spark, d).select("event_id", *ANSWER_FIELDS)


@query(
    "answer_outside_types",
    f"""WITH {_LINES} SELECT event_id, deployment_type,
 user_id % 4 = 0 AND contains(deployment_type, 'Web Service') AS outside_valid_types FROM parsed""",
    ANSWERS,
)
def answer_outside_types(spark, d):
    course = F.when(F.col("user_id") % 4 == 0, "course_a").otherwise("course_b")
    typed = with_valid_types(parsed(spark, d).withColumn("course", course), TYPES)
    flagged = an.flag_outside_types(typed)
    return flagged.select("event_id", "deployment_type", "outside_valid_types")


def _sql_text(s: str) -> str:
    return " || chr(10) || ".join("'" + p.replace("'", "''") + "'" for p in s.split("\n"))


_PROMPT_PARTS = {
    course: _sql_text(
        f"\nDEPLOYMENT TYPE, one of {', '.join(types)}, Unknown:\n- "
        + "\n- ".join(fa.TYPE_HELP[t] for t in types)
        + "\nName both types of a mixed project. A dashboard alone is not Streaming.\n"
        "CLOUD PROVIDER: GCP, AWS, Azure, another one, or Unknown.\n"
        "Answer in exactly these lines:\nDEPLOYMENT: <types>\nDEPLOYMENT_REASON: <reason>\n"
        "CLOUD: <provider>\nCLOUD_REASON: <reason>"
    )
    for course, types in {**TYPES, "other": list(fa.ALL_TYPES)}.items()
}


@query(
    "prompt_classify",
    f"""SELECT submission_id, md5({_sql_text(chr(10).join(['Classify the repository by its code and configuration.', 'REPOSITORY URL: ']))}
 || project_url || {_sql_text(chr(10) + 'FILES:' + chr(10))} || reason ||
 CASE WHEN course = 'course_a' THEN {_PROMPT_PARTS['course_a']} ELSE {_PROMPT_PARTS['other']} END) AS digest
FROM submissions""",
    SUBS,
)
def prompt_classify(spark, d):
    asked = an.class_requests(with_valid_types(subs(spark, d), TYPES), "reason")
    return asked.select("submission_id", F.md5("prompt").alias("digest"))


_ASK_TITLES = _sql_text(
    "Propose 5 different titles of 3 to 5 words for the project below, one per line.\n"
    "Name its data domain and what it does; leave out course names, filler words and "
    "technology the summary does not mention.\n"
)


@query(
    "prompt_title",
    f"""SELECT submission_id, md5({_ASK_TITLES} ||
 CASE WHEN contains(lower(deployment_type), 'streaming') THEN {_sql_text(fa.STREAM_HINT)} ELSE {_sql_text(fa.BATCH_HINT)} END ||
 {_sql_text(chr(10) + 'Project URL: ')} || project_url || {_sql_text(chr(10) + 'Project summary: ')} || reason ||
 {_sql_text(chr(10) + 'Titles:')}) AS digest FROM submissions""",
    SUBS,
)
def prompt_title(spark, d):
    asked = ti.title_requests(subs(spark, d).withColumn("summary", F.col("reason")))
    return asked.select("submission_id", F.md5("prompt").alias("digest"))


# ---------------------------------------------------------------- titles

_GENERIC = ", ".join(f"'{w}'" for w in GENERIC_WORDS)
_TERMS = " + ".join(f"CAST(contains(lower(title), '{t}') AS INT)" for t in GENERIC_TERMS)


def _titles_sql(source: str, response: str, out: str) -> str:
    return f"""
{out}_raw AS (SELECT project_id, project_url, summary, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (
  SELECT *, string_split({response}, chr(10)) AS ls FROM {source})),
{out}_bare AS (SELECT project_id, project_url, summary, i, regexp_replace(trim(line), '^[-0-9]+\\.\\s*', '') AS title FROM {out}_raw),
{out} AS (SELECT project_id, any_value(project_url) AS project_url, any_value(summary) AS summary, title, min(i) AS i
 FROM {out}_bare WHERE title <> '' GROUP BY project_id, title)"""


def _scores_sql(source: str, out: str) -> str:
    return f"""
{out}_words AS (SELECT *, list_filter(regexp_extract_all(lower(project_url || ' ' || summary), '[\\p{{L}}\\p{{N}}_]+'),
  lambda w: w NOT IN ({_GENERIC}) AND length(w) > 2) AS known,
 list_filter(regexp_split_to_array(lower(title), '\\s+'), lambda w: w <> '') AS tokens,
 regexp_extract_all(lower(title), '[\\p{{L}}\\p{{N}}_]+') AS runs FROM {source}),
{out} AS (SELECT *, CAST(CASE WHEN len(tokens) BETWEEN 3 AND 5 THEN 2 ELSE -1 END
 + len(list_filter(tokens, lambda w: list_contains(known, w))) - ({_TERMS})
 - CASE WHEN len(list_filter(runs, lambda w: w NOT IN ({_GENERIC}))) < 2 THEN 2 ELSE 0 END
 - CASE WHEN len(runs) > 0 AND runs[1] IN ({_GENERIC}) THEN 1 ELSE 0 END
 + CASE WHEN contains(title, ':') OR contains(title, '-') THEN 1 ELSE 0 END AS INT) AS score FROM {out}_words)"""


_SCORED = f"{_titles_sql('title_responses', 'response', 't')}, {_scores_sql('t', 's')}"
_BEST = f"""{_SCORED},
best AS (SELECT project_id, project_url, summary, title AS best_title, score AS best_score FROM s
 QUALIFY row_number() OVER (PARTITION BY project_id ORDER BY score DESC, i) = 1)"""
TITLES = ("title_responses",)
_FEEDBACK = "'The best title is ''' || best_title || ''' with a score of ' || best_score || '.' AS feedback"


def title_rows(spark, d):
    return ti.parse_titles(view(spark, d, "title_responses"))


def best(spark, d):
    return ti.best_titles(ti.score_titles(title_rows(spark, d)))


@query(
    "title_parse",
    f"WITH {_titles_sql('title_responses', 'response', 't')} SELECT project_id, title, "
    "CAST(row_number() OVER (PARTITION BY project_id ORDER BY i) - 1 AS INT) AS pos FROM t",
    TITLES,
)
def title_parse(spark, d):
    rows = title_rows(spark, d)
    listed = rows.select("project_id", F.posexplode_outer("titles").alias("pos", "title"))
    return listed.where(F.col("pos").isNotNull())


@query("title_score", f"WITH {_SCORED} SELECT project_id, title, score FROM s", TITLES)
def title_score(spark, d):
    scored = ti.score_titles(title_rows(spark, d))
    listed = scored.select("project_id", F.inline_outer("scored"))
    return listed.where(F.col("title").isNotNull())


@query(
    "title_best",
    f"WITH {_BEST} SELECT project_id, best_title, best_score, {_FEEDBACK} FROM best",
    TITLES,
)
def title_best(spark, d):
    return best(spark, d).select("project_id", "best_title", "best_score", "feedback")


# The planted titles all score well, so the query asks again below a higher mark.
MARK = 7
_SECOND = f"""{_BEST},
second AS (SELECT b.project_id, b.project_url, b.summary, r.response FROM best b
 JOIN title_responses r ON r.project_id = (b.project_id + 1) % (SELECT count(*) FROM part) WHERE best_score < {MARK}),
{_titles_sql('second', 'response', 't2')}, {_scores_sql('t2', 's2')},
merged AS (SELECT project_id, title, score, i, 0 AS turn FROM s UNION ALL SELECT project_id, title, score, i, 1 FROM s2),
final AS (SELECT project_id, title AS best_title, score AS best_score FROM merged
 QUALIFY row_number() OVER (PARTITION BY project_id ORDER BY score DESC, turn, i) = 1)"""


@query("title_regenerate", f"WITH {_SECOND} SELECT project_id, best_title, best_score FROM final", TITLES)
def title_regenerate(spark, d):
    first = best(spark, d).drop("response")
    # Answers to the second request: those of the next project. Rows that score well ignore them.
    rows = view(spark, d, "title_responses")
    n = rows.agg(F.count(F.lit(1))).scalar()
    second = rows.select(((F.col("project_id") + n - 1) % n).alias("project_id"), "response")
    final = ti.with_second_answers(first, second, "project_id", MARK)
    return final.select("project_id", "best_title", "best_score")


@query(
    "regenerate_requests",
    f"""WITH {_BEST} SELECT project_id, md5({_ASK_TITLES} || '' || {_sql_text(chr(10) + 'Project URL: ')} || project_url
 || {_sql_text(chr(10) + 'Project summary: ')} || summary || {_sql_text(chr(10) + 'Titles:')}) AS digest
FROM best WHERE best_score < {MARK}""",
    TITLES,
)
def regenerate_requests(spark, d):
    asked = ti.to_regenerate(best(spark, d), MARK)
    return asked.select("project_id", F.md5("prompt").alias("digest"))


# ---------------------------------------------------------------- states


@query(
    "carry_enrichment",
    """
WITH cleaned AS (SELECT DISTINCT project_url FROM submissions WHERE year >= '1995'),
old AS (SELECT * FROM submissions WHERE year < '1998'
 QUALIFY row_number() OVER (PARTITION BY project_url ORDER BY submission_id) = 1)
SELECT c.project_url, project_title, deployment_type, reason, cloud
FROM cleaned c LEFT JOIN old o ON c.project_url IS NOT DISTINCT FROM o.project_url""",
    SUBS,
)
def carry_enrichment(spark, d):
    rows = subs(spark, d)
    cleaned = cl.clean_and_deduplicate(rows.where("year >= '1995'"))
    return en.carry_enrichment(cleaned, rows.where("year < '1998'"), order_by=["submission_id"])


_KNOWN = "coalesce(lower(trim({c})) NOT IN ('unknown', 'error'), false)"
_T, _D = _KNOWN.format(c="project_title"), _KNOWN.format(c="deployment_type")


def _needs_sql(force: str) -> str:
    return f"""
needs AS (SELECT *, NOT coalesce(starts_with(reason, '404:'), false) AND ({force} OR NOT ({_T} AND {_D})) AS needs_processing,
 {force} OR deployment_type IS NULL OR coalesce(lower(trim(deployment_type)) = 'unknown', false) AS needs_classification,
 {force} OR NOT {_T} OR coalesce(contains(lower(reason), 'no files fetched'), false) AS needs_title FROM inputs)"""


@query(
    "needs_processing",
    f"WITH inputs AS (SELECT * FROM submissions), {_needs_sql('(score > 300000)')} "
    "SELECT submission_id, needs_processing, needs_classification, needs_title FROM needs",
    SUBS,
)
def needs_processing(spark, d):
    flagged = en.with_needs(subs(spark, d), F.col("score") > 300000)
    flags = ("needs_processing", "needs_classification", "needs_title")
    return flagged.select("submission_id", *flags)


# What is known about the repositories, spread over the rows so that every state occurs.
_FACTS = """
inputs AS (SELECT s.*, author_id % 7 = 0 AS not_found, author_id % 7 NOT IN (0, 1) AS has_files,
 CASE WHEN author_id % 5 = 0 THEN NULL ELSE 'a summary' END AS summary,
 CASE WHEN author_id % 3 = 0 THEN NULL ELSE concat('Title of ', s.course) END AS new_title,
 CASE WHEN author_id % 13 = 0 THEN concat('timeout ', s.course) END AS failure,
 coalesce(a.deployment_type, 'Unknown') AS new_type, coalesce(a.deployment_reason, 'LLM returned no response') AS new_reason,
 coalesce(a.cloud_provider, 'Unknown') AS new_cloud FROM {source} s LEFT JOIN parsed a ON a.event_id = s.submission_id)"""


def _states_sql(force: str, retry: bool = False) -> str:
    failure = "false" if retry else "failure IS NOT NULL"
    title = "coalesce(nullif(project_title, ''), 'Error')"
    why = f"CASE WHEN project_url IS NULL THEN '{en.NO_URL}' ELSE failure END"
    noted = "(needs_title AND note IS NOT NULL)"
    return f"""{_needs_sql(force)},
noted AS (SELECT *, CASE WHEN coalesce(summary, '') = '' THEN '{en.NOTE_NO_SUMMARY}' WHEN new_title IS NULL THEN '{en.NOTE_NO_TITLES}' END AS note,
 CASE WHEN needs_classification THEN new_type ELSE deployment_type END AS d1,
 CASE WHEN needs_classification THEN new_reason ELSE reason END AS r1,
 CASE WHEN needs_classification THEN new_cloud ELSE cloud END AS c1 FROM needs),
staged AS (SELECT *, CASE WHEN NOT needs_processing THEN 'kept' WHEN project_url IS NULL OR {failure} THEN 'failed'
  WHEN not_found THEN 'gone' WHEN NOT has_files THEN 'empty' WHEN {noted} AND r1 IS NULL THEN 'unnoted'
  WHEN {noted} THEN 'noted' ELSE 'done' END AS stage FROM noted),
states AS (SELECT submission_id, project_url, author_id, course, score,
 CASE stage WHEN 'kept' THEN project_title WHEN 'failed' THEN {title} WHEN 'done' THEN CASE WHEN needs_title THEN new_title ELSE project_title END ELSE 'Unknown' END AS project_title,
 CASE stage WHEN 'kept' THEN deployment_type WHEN 'failed' THEN 'Error' WHEN 'unnoted' THEN 'Error' WHEN 'gone' THEN 'Unknown' WHEN 'empty' THEN 'Unknown' ELSE d1 END AS deployment_type,
 CASE stage WHEN 'kept' THEN reason WHEN 'failed' THEN {why} WHEN 'unnoted' THEN '{en.NO_REASON}' WHEN 'gone' THEN '{en.NOT_FOUND_REASON}'
  WHEN 'empty' THEN '{en.NO_FILES_REASON}' WHEN 'noted' THEN r1 || note ELSE r1 END AS reason,
 CASE stage WHEN 'kept' THEN cloud WHEN 'failed' THEN 'Error' WHEN 'unnoted' THEN 'Error' WHEN 'gone' THEN 'Unknown' WHEN 'empty' THEN 'Unknown' ELSE c1 END AS cloud,
 CASE WHEN stage IN ('kept', 'gone', 'empty') THEN 'skip' WHEN stage IN ('failed', 'unnoted') THEN 'error' ELSE 'success' END AS status FROM staged)"""


_FIRST = f"{_LINES}, {_FACTS.format(source='submissions')}, {_states_sql('false')}"
_RETRIED = f"""{_FIRST},
again AS (WITH failed AS (SELECT * FROM states WHERE status = 'error'), {_FACTS.format(source='failed')},
 {_states_sql('true', retry=True)} SELECT * FROM states),
retried AS (SELECT s.submission_id, CASE WHEN a.submission_id IS NULL THEN s.project_title ELSE a.project_title END AS project_title,
 CASE WHEN a.submission_id IS NULL THEN s.deployment_type ELSE a.deployment_type END AS deployment_type,
 CASE WHEN a.submission_id IS NULL THEN s.reason ELSE a.reason END AS reason,
 CASE WHEN a.submission_id IS NULL THEN s.cloud ELSE a.cloud END AS cloud,
 coalesce(a.status, s.status) AS status FROM states s LEFT JOIN again a USING (submission_id))"""
WORK = ("submissions", "model_answers")
ROW = ("submission_id", *RESULTS, "status")


def with_facts(df, spark, d, failing=True):
    author = F.col("author_id")
    answer = parsed(spark, d).select(
        F.col("event_id").alias("submission_id"),
        F.col("deployment_type").alias("new_type"),
        F.col("deployment_reason").alias("new_reason"),
        F.col("cloud_provider").alias("new_cloud"),
    )
    joined = df.join(answer, "submission_id", "left")
    failure = F.when(author % 13 == 0, F.concat(F.lit("timeout "), F.col("course")))
    return joined.withColumns(
        {
            "new_type": F.coalesce("new_type", F.lit("Unknown")),
            "new_reason": F.coalesce("new_reason", F.lit("LLM returned no response")),
            "new_cloud": F.coalesce("new_cloud", F.lit("Unknown")),
            "not_found": author % 7 == 0,
            "has_files": ~(author % 7).isin(0, 1),
            "summary": F.when(author % 5 != 0, "a summary"),
            "new_title": F.when(author % 3 != 0, F.concat(F.lit("Title of "), F.col("course"))),
            "failure": failure if failing else F.lit(None).cast("string"),
        }
    )


def states(spark, d):
    return en.apply_states(with_facts(subs(spark, d), spark, d))


def retried(spark, d):
    return en.retry_states(with_facts(subs(spark, d), spark, d))


@query("enrich_states", f"WITH {_FIRST} SELECT {', '.join(ROW)} FROM states", WORK)
def enrich_states(spark, d):
    return states(spark, d).select(*ROW)


@query("retry_merge", f"WITH {_RETRIED} SELECT {', '.join(ROW)} FROM retried", WORK)
def retry_merge(spark, d):
    return retried(spark, d).select(*ROW)


_STATUS = ", ".join(f"count(*) FILTER (status = '{s}') AS {s}" for s in ("success", "skip", "error"))


@query("status_counts", f"WITH {_RETRIED} SELECT {_STATUS} FROM retried", WORK)
def status_counts(spark, d):
    return en.status_counts(retried(spark, d))


@query(
    "run_metrics",
    f"WITH {_FIRST} SELECT {_STATUS}, count(*) AS total, count(*) / 8.0 AS rows_per_second FROM states",
    WORK,
)
def run_metrics(spark, d):
    return en.run_metrics(states(spark, d), 8.0)


_CHANGED = ", ".join(
    f"CASE WHEN o.{c} IS DISTINCT FROM n.{c} THEN '{c}' END" for c in RESULTS
)


@query(
    "changed_rows",
    f"""WITH {_FIRST},
diff AS (SELECT o.submission_id, concat_ws(',', {_CHANGED}) AS changed,
 {', '.join(f'o.{c} AS old_{c}, n.{c} AS new_{c}' for c in RESULTS)}
 FROM submissions o JOIN states n USING (submission_id))
SELECT * FROM diff WHERE changed <> ''""",
    WORK,
)
def changed_rows(spark, d):
    diff = en.changed_states(with_facts(subs(spark, d), spark, d), key="submission_id")
    return diff.withColumn("changed", F.array_join("changed", ","))


@query(
    "single_project",
    "SELECT submission_id, project_url FROM submissions WHERE rtrim(project_url, '/') = 'https://github.com/user7/repo1'",
    SUBS,
)
def single_project(spark, d):
    found = en.single_project(subs(spark, d), "https://github.com/user7/repo1/")
    return found.select("submission_id", "project_url")


@query(
    "work_limit",
    f"WITH inputs AS (SELECT * FROM submissions), {_needs_sql('false')} SELECT submission_id FROM needs "
    "WHERE needs_processing ORDER BY submission_id LIMIT 250",
    SUBS,
)
def work_limit(spark, d):
    work = subs(spark, d).where(en.needs_processing())
    return en.work_limit(work, 250, ["submission_id"]).select("submission_id")


@query(
    "result_columns",
    "SELECT DISTINCT project_url, CAST(NULL AS VARCHAR) AS project_title, CAST(NULL AS VARCHAR) AS deployment_type, "
    "CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS VARCHAR) AS cloud FROM submissions WHERE project_url IS NOT NULL",
    SUBS,
)
def result_columns(spark, d):
    return cl.with_result_columns(cl.clean_and_deduplicate(subs(spark, d).select("project_url")))
