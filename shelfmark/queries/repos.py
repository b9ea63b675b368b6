"""Queries over repositories: files, branches, texts, payloads, keywords."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.functions.answers import decoded_payload, strictly_decoded
from shelfmark.functions.keywords import CLOUD_KEYWORDS, DEPLOYMENT_KEYWORDS, word_bounded
from shelfmark.operators import keywords as kw
from shelfmark.operators import repos as rp
from shelfmark.operators.answers import infer, with_request_hash
from shelfmark.operators.taxonomy import classify_by_table
from shelfmark.operators.titles import summary_requests
from shelfmark.queries.registry import query
from shelfmark.queries.views import table, view

KEYS = ["repo_id"]


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _contains(column: str, values) -> str:
    return "(" + " OR ".join(f"contains({column}, '{v}')" for v in values) + ")"


_EXTENSIONS = "|".join(e[1:] for e in rp.EXCLUDED_EXTENSIONS)
_KEY_FILE = (
    f"(NOT regexp_matches(lower(path), '\\.({_EXTENSIONS})$') "
    f"AND NOT {_contains('lower(path)', rp.EXCLUDED_FOLDERS)} "
    f"AND ({_contains(chr(34) + 'name' + chr(34), dict.fromkeys(k.lower() for k in rp.KEY_FILES))} "
    f"OR {_contains('lower(path)', rp.KEY_PATTERNS)}))"
)
_INSIDE = "(coalesce(subpath, '') <> '' AND starts_with(lower(path), lower(subpath) || '/'))"
_REACHABLE = f"(coalesce(subpath, '') = '' OR {_INSIDE} OR lower(path) = lower(subpath) OR NOT contains(path, '/'))"
_FILES = "files AS (SELECT *, lower(regexp_replace(path, '^.*/', '')) AS name FROM repo_files WHERE type = 'blob')"
FILES = ("repo_projects", "repo_files", "repo_status")

_CHOSEN = """
facts AS (SELECT p.*, status_code, default_branch FROM repo_projects p LEFT JOIN (
 SELECT * FROM repo_status QUALIFY row_number() OVER (PARTITION BY repo_id ORDER BY landed_at DESC) = 1) s USING (repo_id)),
landed AS (SELECT DISTINCT repo_id, branch AS b FROM repo_files),
chosen AS (SELECT p.*, CASE
  WHEN branch IN (SELECT b FROM landed l WHERE l.repo_id = p.repo_id) THEN branch
  WHEN 'main' IN (SELECT b FROM landed l WHERE l.repo_id = p.repo_id) THEN 'main'
  WHEN 'master' IN (SELECT b FROM landed l WHERE l.repo_id = p.repo_id) THEN 'master'
  WHEN default_branch IN (SELECT b FROM landed l WHERE l.repo_id = p.repo_id) THEN default_branch
 END AS tree_branch FROM facts p)"""
_RANKED = f"""{_CHOSEN}, {_FILES},
ranked AS (SELECT * FROM (
 SELECT c.repo_id, c.branch, c.default_branch, f.path, c.subpath, c.tree_branch,
  row_number() OVER (PARTITION BY c.repo_id ORDER BY {_INSIDE} DESC,
   length(path) - length(replace(path, '/', '')), path) AS rank
 FROM chosen c JOIN files f ON f.repo_id = c.repo_id AND f.branch = c.tree_branch
 WHERE {_KEY_FILE} AND {_REACHABLE}) WHERE rank <= {rp.MAX_FILES})"""


def projects(spark, d):
    return view(spark, d, "repo_projects").drop("status_letter")


def status(spark, d):
    return view(spark, d, "repo_status")


def trees(spark, d):
    return view(spark, d, "repo_files")


def chosen(spark, d):
    return rp.choose_tree(projects(spark, d), trees(spark, d), status(spark, d), KEYS)


def contents(spark, d):
    return view(spark, d, "file_contents")


@query(
    "key_files",
    f"""WITH {_FILES} SELECT repo_id, path, branch, {_KEY_FILE} AND {_REACHABLE} AS fetch
FROM files JOIN (SELECT repo_id, subpath FROM repo_projects) p USING (repo_id)""",
    FILES,
)
def key_files(spark, d):
    blobs = trees(spark, d).where("type = 'blob'")
    joined = blobs.join(projects(spark, d).select("repo_id", "subpath"), "repo_id")
    fetch = rp.should_fetch(F.col("path"), F.col("subpath"))
    return joined.select("repo_id", "path", "branch", fetch.alias("fetch"))


@query(
    "branch_choice",
    f"WITH {_CHOSEN} SELECT repo_id, branch, tree_branch, tree_branch IS NULL AND coalesce(status_code = 404, false) AS not_found FROM chosen",
    FILES,
)
def branch_choice(spark, d):
    return chosen(spark, d).select("repo_id", "branch", "tree_branch", "not_found")


@query(
    "key_files_top",
    f"WITH {_RANKED} SELECT repo_id, path, CAST(rank AS INT) AS rank FROM ranked",
    FILES,
)
def key_files_top(spark, d):
    return rp.ranked_files(chosen(spark, d), trees(spark, d), keys=KEYS).select("repo_id", "path", "rank")


_FETCHED = f"""{_RANKED},
texts AS (SELECT * FROM file_contents WHERE length(content) > 0
 QUALIFY row_number() OVER (PARTITION BY repo_id, ref, path ORDER BY landed_at DESC) = 1),
fetched AS (SELECT r.*, content FROM ranked r JOIN texts t ON t.repo_id = r.repo_id AND t.path = r.path
 AND CASE WHEN coalesce(r.branch, default_branch) IS NOT NULL THEN t.ref = coalesce(r.branch, default_branch)
  WHEN EXISTS (SELECT 1 FROM texts x WHERE x.repo_id = r.repo_id AND x.path = r.path AND x.ref IS NULL) THEN t.ref IS NULL
  ELSE t.ref = r.tree_branch END)"""
TEXTS = ("repo_projects", "repo_files", "repo_status", "file_contents")


def fetched(spark, d, per_file=None, text=None, gathered=False):
    tables = chosen(spark, d), trees(spark, d), contents(spark, d)
    return rp.key_files(*tables, keys=KEYS, per_file=per_file, text=text, gathered=gathered)


@query(
    "key_file_texts",
    f"WITH {_FETCHED} SELECT repo_id, path, CAST(rank AS INT) AS rank, md5(content) AS digest FROM fetched",
    TEXTS,
)
def key_file_texts(spark, d):
    digests = fetched(spark, d, text=F.md5("content"))
    return digests.select("repo_id", "path", "rank", F.col("content").alias("digest"))


@query(
    "best_readme",
    f"""WITH {_FETCHED}
SELECT repo_id, path AS readme_path, trim(replace(substring(content, 1, 700), chr(10), ' '), ' ' || chr(9) || chr(13)) AS readme_preview
FROM fetched WHERE name_of(path) IN ('readme.md', 'readme')
QUALIFY row_number() OVER (PARTITION BY repo_id
 ORDER BY length(path) - length(replace(path, '/', '')), rank) = 1""".replace(
        "name_of(path)", "lower(regexp_replace(path, '^.*/', ''))"
    ),
    TEXTS,
)
def best_readme(spark, d):
    return rp.best_readme(fetched(spark, d, 700), by=KEYS)


def _context_sql(layout: str) -> str:
    before, after, tail, per_file, total, mark = rp.LAYOUTS[layout]
    text = lambda s: " || ".join(
        "chr(10)" if part == "\n" else f"'{part}'" for part in _pieces(s)
    ) or "''"
    block = f"{text(before)} || path || {text(after)} || substring(content, 1, {per_file}) || {text(tail)}"
    return f"""WITH {_FETCHED},
joined AS (SELECT repo_id, string_agg({block}, '' ORDER BY rank) AS t FROM fetched WHERE length(content) > 0 GROUP BY repo_id),
done AS (SELECT repo_id, CASE WHEN length(t) > {total} THEN substring(t, 1, {total}) || {text(mark)} ELSE t END AS t FROM joined)
SELECT repo_id, length(t) AS n, md5(t) AS digest FROM done"""


def _pieces(s: str) -> list[str]:
    out: list[str] = []
    for i, part in enumerate(s.split("\n")):
        out += (["\n"] if i else []) + ([part] if part else [])
    return out


def _context(layout: str):
    @query(f"repo_context_{layout}", _context_sql(layout), TEXTS)
    def run(spark, d):
        texts = rp.context(fetched(spark, d, rp.longest_cut([layout]), gathered=True), layout, KEYS)
        return texts.select(
            "repo_id",
            F.length("context").cast("bigint").alias("n"),
            F.md5("context").alias("digest"),
        )


for _layout in rp.LAYOUTS:
    _context(_layout)



@query(
    "summary_requests",
    _context_sql("title").replace(
        "SELECT repo_id, length(t) AS n, md5(t) AS digest FROM done",
        "SELECT repo_id, md5('Describe purpose and key features of this repository in two sentences:' "
        "|| chr(10) || t) AS digest FROM done",
    ),
    TEXTS,
)
def summaries(spark, d):
    texts = rp.context(fetched(spark, d, rp.longest_cut(["title"]), gathered=True), "title", KEYS)
    asked = summary_requests(texts)
    return asked.select("repo_id", F.md5("prompt").alias("digest"))


@query(
    "payload_decode",
    "SELECT doc_id, md5(nullif(substring(text, 1, 8000), '')) AS digest, md5(text) AS whole_digest FROM documents",
)
def payload_decode(spark, d):
    docs = table(spark, d, "documents")
    coded = docs.select("doc_id", F.base64(F.col("text").cast("binary")).alias("c"))
    return coded.select(
        "doc_id",
        F.md5(decoded_payload(F.col("c"))).alias("digest"),
        F.md5(strictly_decoded(F.col("c"))).alias("whole_digest"),
    )


@query(
    "payload_decode_lower",
    "SELECT doc_id, md5(lower(text)) AS digest FROM documents",
)
def payload_decode_lower(spark, d):
    docs = table(spark, d, "documents")
    coded = docs.select("doc_id", F.base64(F.col("text").cast("binary")).alias("c"))
    return coded.select("doc_id", F.md5(F.lower(strictly_decoded(F.col("c")))).alias("digest"))


# ---------------------------------------------------------------- keywords


def _hit(keyword: str) -> str:
    return f"regexp_matches(content, '{word_bounded(keyword)}')"


_DEPLOYMENT = " ".join(
    f"WHEN {_hit(k)} THEN '{label}|{k}'" for label, group in DEPLOYMENT_KEYWORDS.items() for k in group
)
_SCORES = ", ".join(
    "(" + " + ".join(f"CAST({_hit(k)} AS INT)" for k in group) + f") AS s{i}"
    for i, group in enumerate(CLOUD_KEYWORDS.values())
)
_BEST = "greatest(" + ", ".join(f"s{i}" for i in range(len(CLOUD_KEYWORDS))) + ")"
_CLOUD = " ".join(f"WHEN s{i} = best THEN '{label}'" for i, label in enumerate(CLOUD_KEYWORDS))
_KEYWORDS = f"""
typed AS (SELECT doc_id, CASE {_DEPLOYMENT} ELSE 'Unknown|Unknown' END AS t FROM readmes),
scored AS (SELECT doc_id, {_SCORES} FROM readmes),
clouds AS (SELECT doc_id, CASE WHEN best = 0 THEN 'Unknown' {_CLOUD} END AS cloud
 FROM (SELECT *, {_BEST} AS best FROM scored)),
classified AS (SELECT doc_id, split_part(t, '|', 1) AS deployment_type, split_part(t, '|', 2) AS reason, cloud
 FROM typed JOIN clouds USING (doc_id))"""
READMES = ("readmes",)


@query(
    "keyword_deployment",
    f"WITH {_KEYWORDS} SELECT doc_id, deployment_type, reason FROM classified",
    READMES,
)
def keyword_deployment(spark, d):
    found = kw.deployment_by_keyword(view(spark, d, "readmes"))
    return found.select("doc_id", "deployment_type", "reason")


@query("keyword_cloud", f"WITH {_KEYWORDS} SELECT doc_id, cloud FROM classified", READMES)
def keyword_cloud(spark, d):
    return kw.cloud_by_keyword(view(spark, d, "readmes")).select("doc_id", "cloud")


def classified(spark, d):
    key = F.concat(F.lit("https://github.com/u/d"), F.col("doc_id").cast("string"))
    urls = table(spark, d, "documents").select("doc_id", key.alias("project_url"))
    labelled = table(spark, d, "labels").select("doc_id").distinct()
    readmes = view(spark, d, "readmes").join(labelled, "doc_id", "left_semi")
    return kw.classify_by_keyword(urls, readmes.select(key.alias("project_url"), "content"))


_CLASSIFIED = f"""{_KEYWORDS},
projects AS (SELECT doc_id, 'https://github.com/u/d' || doc_id AS project_url,
 doc_id IN (SELECT doc_id FROM labels) AS has_readme FROM documents),
result AS (SELECT project_url, CASE WHEN has_readme THEN deployment_type ELSE 'Unknown' END AS deployment_type,
 CASE WHEN has_readme THEN reason ELSE 'Unknown' END AS reason,
 CASE WHEN has_readme THEN cloud ELSE 'Unknown' END AS cloud FROM projects JOIN classified USING (doc_id))"""


@query(
    "keyword_classify",
    f"WITH {_CLASSIFIED} SELECT project_url, deployment_type, reason, cloud FROM result",
    READMES,
)
def keyword_classify(spark, d):
    return classified(spark, d).select("project_url", "deployment_type", "reason", "cloud")


@query("unknown_clouds", f"WITH {_CLASSIFIED} SELECT project_url FROM result WHERE cloud = 'Unknown'", READMES)
def unknown_clouds(spark, d):
    return kw.unknown_rows(classified(spark, d))


@query(
    "unknown_cloud_rate",
    f"WITH {_CLASSIFIED} SELECT count(*) FILTER (cloud = 'Unknown') AS unknown, count(*) AS total, "
    "round(count(*) FILTER (cloud = 'Unknown') * 100.0 / count(*), 6) AS percent FROM result",
    READMES,
)
def unknown_cloud_rate(spark, d):
    rate = kw.unknown_rate(classified(spark, d))
    return rate.withColumn("percent", F.round("percent", 6))


@query(
    "model_hook",
    "SELECT DISTINCT sha256(text) AS request_hash, CAST(length(text) AS VARCHAR) AS response FROM conversations",
)
def model_hook(spark, d):
    asked = table(spark, d, "conversations").select(F.col("text").alias("prompt"))
    model = lambda prompts: [str(len(p)) for p in prompts]
    return infer(with_request_hash(asked), model).select("request_hash", "response")


# A taxonomy that is a table: two words of every benchmark text, as keywords of seven labels.
_TABLE = """
keywords AS (SELECT DISTINCT lower(regexp_extract(text, '([a-zA-Z]+ [a-zA-Z]+)', 1)) AS keyword, CAST(item_id % 7 AS INT) AS label_order FROM benchmark),
named AS (SELECT keyword, label_order, concat('label', CAST(label_order AS STRING)) AS label FROM keywords WHERE keyword <> '')"""


@query(
    "keyword_table",
    f"""WITH {_TABLE.replace('STRING', 'VARCHAR')},
held AS (SELECT doc_id, label, label_order, keyword FROM documents, named
 WHERE contains(lower(text), keyword) AND regexp_matches(text, '(?i)(^|[^\\p{{L}}\\p{{N}}_])' || keyword || '($|[^\\p{{L}}\\p{{N}}_])')),
counted AS (SELECT doc_id, label, label_order, count(DISTINCT keyword) AS n, min(keyword) AS keyword FROM held GROUP BY ALL)
SELECT doc_id, label, keyword, n FROM counted QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, label_order) = 1""",
)
def keyword_table(spark, d):
    words = F.lower(F.regexp_extract("text", "([a-zA-Z]+ [a-zA-Z]+)", 1))
    named = table(spark, d, "benchmark").select(words.alias("keyword"), (F.col("item_id") % 7).cast("int").alias("label_order")).distinct()
    taxonomy = named.where("keyword <> ''").select(
        F.lit("benchmark").alias("kind"),
        F.lit("most").alias("rule"),
        F.concat(F.lit("label"), F.col("label_order").cast("string")).alias("label"),
        "label_order",
        "keyword",
        F.lit(0).alias("keyword_order"),
    )
    found = classify_by_table(table(spark, d, "documents"), taxonomy, "doc_id", "text")
    return found.select("doc_id", "label", "keyword", "n")
