"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.chat_format import digests, format_chats
from shelfmark.llm.embedding_dedup import near_vectors
from shelfmark.llm.fill_middle import fill_in_middle, restored
from shelfmark.llm.jaccard_join import similar_sets
from shelfmark.llm.language_id import language_ids
from shelfmark.llm.lexical_search import lexical_search
from shelfmark.llm.license_scan import NOTICES, license_scan
from shelfmark.llm.mixing import mix_sources
from shelfmark.llm.packing import pack
from shelfmark.llm.quality_classifier import quality_scores
from shelfmark.llm.quality_rules import RULES, quality_rules
from shelfmark.llm.suffix_dedup import without_repeats
from shelfmark.llm.token_counts import token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary())


# op7: the verdict of a rule on a host needs a beta prior, fitted by moments below.
@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _op7_sql() -> str:
    rules = list(RULES)
    rates = ", ".join(f"avg(f_{r} / n) AS m_{r}, var_pop(f_{r} / n) - avg((f_{r} / n) * (1 - f_{r} / n) / n) AS v_{r}" for r in rules)
    weight = lambda r: f"least(greatest(m_{r} * (1 - m_{r}) / greatest(v_{r}, 1e-9) - 1, 1.0), 1e6)"
    good = " AND ".join(f"(f_{r} + m_{r} * {weight(r)}) / (n + {weight(r)}) <= 0.5" for r in rules)
    return f"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '[\\x20\\x09-\\x0D]+', '', 'g') <> '') AS l FROM rows),
wins AS (SELECT r, i, struct_pack(a := w[i], b := w[i + 1], c := w[i + 2]) AS k
    FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM wins) WHERE c > 1),
covered AS (SELECT r, count(DISTINCT i + o) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS o) GROUP BY r),
counts AS (SELECT words.r, doc_id, source, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(l) AS n_lines,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
    FROM words LEFT JOIN covered USING (r)),
failed AS (SELECT *, {", ".join(f"({c}) AS fails_{r}" for r, c in RULES.items())} FROM counts),
hosts AS (SELECT source AS host, count(*)::DOUBLE AS n, {", ".join(f"sum(fails_{r}::INT)::DOUBLE AS f_{r}" for r in rules)} FROM failed GROUP BY source),
prior AS (SELECT {rates} FROM hosts),
verdicts AS (SELECT host, {good} AS good FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fails_short OR fails_repeats) AS base_failed,
    NOT ({" OR ".join(f"fails_{r}" for r in rules)}) AND good AS kept
FROM failed JOIN verdicts ON source IS NOT DISTINCT FROM host"""


ORACLES["op7_quality_rules"] = _op7_sql()


@query
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


# Targets by filling up level by level; draws by one running sum over each whole source.
ORACLES["op9_source_mix"] = """
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
drawn AS (SELECT r, doc_id, source, len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    -ln((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE + 0.5) / (1::BIGINT << 48)::DOUBLE)
    / greatest(0.05, 1 - 4.0::DOUBLE * length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) / greatest(length(t), 1)) AS k FROM rows),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size, [3.0::DOUBLE, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
    FROM drawn GROUP BY source),
caps AS (SELECT *, 2.0::DOUBLE * source_size AS cap, sum(source_size) OVER () AS s, sum(w) OVER () AS ws FROM sizes),
levels AS (SELECT *, (1.5::DOUBLE * s - coalesce(sum(cap) OVER b, 0)) / (ws - coalesce(sum(w) OVER b, 0)) AS level FROM caps
    WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source AS src, source_size, least(cap, w * max(CASE WHEN cap / w > level THEN level END) OVER ()) AS target FROM levels),
running AS (SELECT *, floor(target / source_size) AS epochs, target - floor(target / source_size) * source_size AS rest,
    sum(size) OVER (PARTITION BY source ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING) AS upto
    FROM drawn JOIN targets ON source IS NOT DISTINCT FROM src)
SELECT doc_id, size, source_size, target,
    (size * (epochs + CASE WHEN upto <= rest OR (upto - size < rest AND upto - rest < rest - (upto - size)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM running"""


# op3 has no SQL: token ids need a tokenizer. tests/llm/test_packing.py checks it by brute force.
@query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary())


@query
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return digests(format_chats(rows.unionByName(planted)))


# The template adds 15 characters to a user turn, 6 to an assistant's and 16 with the role's name to any
# other, and one backslash to each control string in a text.
ORACLES["op10_chat_format"] = r"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
parts AS (SELECT *, length(text) + len(regexp_extract_all(text, '\[/?INST\]|\[/?TURN\]|</?s>'))
    + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 6 ELSE 16 + length(role) END AS n FROM rows)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(n)::BIGINT AS formatted_chars
FROM parts GROUP BY conv_id"""


# op6 has no SQL: the model is fitted. tests/llm/test_classifiers.py measures it on held-out documents.
@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# op2 has no SQL: the model is fitted. tests/llm/test_classifiers.py measures it on held-out documents.
@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_ids(table(spark, sf_dir, "documents"))


@query
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_sets(table(spark, sf_dir, "documents"), size=3, percent=90)


# All pairs that share a shingle, and the components by reaching out from every document.
ORACLES["op4_jaccard_join"] = """
WITH RECURSIVE words AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (SELECT a.doc_id AS u, b.doc_id AS v FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
    GROUP BY ALL HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (SELECT doc_id AS u, doc_id AS v FROM sets UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u)
SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, min(v) AS component_id FROM sets JOIN reach ON sets.doc_id = u GROUP BY ALL"""


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


# op5's check is all pairs; the index may miss some at the very threshold (recall 0.98), which these tables have none of.
@query
def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


ORACLES["op5_embedding_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM v
    WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS u, vec_id AS v FROM v UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u),
least AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.u = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN least ON u = vec_id"""


# Fixed values of the contract: three phrases and their labels. The operator's own phrases hold them too.
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


@query
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents"), {**NOTICES, **BASE_PHRASES})
    base = F.filter("places", lambda p: p["phrase"].isin(*BASE_PHRASES))
    # A step of its own, so that the places are looked through once.
    found = found.withColumn("_base", base)
    first, labels = F.transform("_base", lambda p: p["first"]), F.transform("_base", lambda p: p["label"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("_base").cast("long").alias("n_base"),
        F.array_min(first).alias("first_word"),
        F.array_max(first).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def _op11_sql() -> str:
    """Phrases by their first word's places; expressions by rewriting them until one symbol is left."""
    phrases = {**NOTICES, **BASE_PHRASES}

    def starts(phrase: str) -> str:
        holds = " AND ".join(f"w[i + {k}] = '{x}'" if k else f"w[i] = '{x}'" for k, x in enumerate(phrase.split()))
        return f"list_filter(range(1, len(w) + 1), lambda i: {holds})"

    named = ", ".join(
        f"CASE WHEN contains(j, ' {p} ') THEN list_transform({starts(p)}, lambda i: struct_pack(phrase := '{p}', label := '{label}', n := {len(p.split())}, word := i - 1)) ELSE [] END"
        for p, label in phrases.items()
    )
    base = ", ".join(f"'{p}'" for p in BASE_PHRASES)
    label = "regexp_replace(x, '(-only|-or-later|\\+)$', '')"
    return rf"""
WITH RECURSIVE texts AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
words AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM texts),
joined AS (SELECT *, ' ' || array_to_string(w, ' ') || ' ' AS j FROM words),
places AS (SELECT *, flatten([{named}]) AS p FROM joined),
tagged AS (SELECT r, rtrim(regexp_extract(unnest(string_split(t, 'spdx-license-identifier:')[2:]), '^[ \t]*["'']?([a-z0-9.+() \t-]*)', 1), ' ' || chr(9) || '-') AS e FROM texts),
pieces AS (SELECT row_number() OVER () AS q, r, regexp_extract_all(e, '[()]|[a-z0-9.+-]+') AS x FROM tagged),
signs AS (SELECT q, r, x, array_to_string(list_transform(x, lambda y: CASE y WHEN 'and' THEN 'o' WHEN 'or' THEN 'o' WHEN 'with' THEN 'w' WHEN '(' THEN '(' WHEN ')' THEN ')' ELSE 'i' END), '') AS s FROM pieces),
steps AS (SELECT q, r, x, replace(regexp_replace(s, 'iwi', 'e', 'g'), 'i', 'e') AS s, 0 AS step FROM signs
    UNION ALL SELECT q, r, x, regexp_replace(regexp_replace(s, 'eoe', 'e', 'g'), '\(e\)', 'e', 'g'), step + 1 FROM steps
    WHERE s <> regexp_replace(regexp_replace(s, 'eoe', 'e', 'g'), '\(e\)', 'e', 'g')),
valid AS (SELECT r, x FROM steps WHERE s = 'e'),
ids AS (SELECT r, x[i] AS x FROM (SELECT r, x, unnest(range(1, len(x) + 1)) AS i FROM valid)
    WHERE x[i] NOT IN ('and', 'or', 'with', '(', ')', 'none', 'noassertion') AND (i = 1 OR x[i - 1] <> 'with')),
said AS (SELECT r, list(CASE WHEN starts_with({label}, 'cc') THEN regexp_replace({label}, '-[0-9]+(\.[0-9]+)*$', '')
    ELSE regexp_replace({label}, '\.0$', '') END) AS l FROM ids GROUP BY r),
based AS (SELECT *, list_filter(p, lambda x: x.phrase IN ({base})) AS b FROM places)
SELECT doc_id, len(w)::BIGINT AS n_words, len(b)::BIGINT AS n_base,
    list_min(list_transform(b, lambda x: x.word))::BIGINT AS first_word, list_max(list_transform(b, lambda x: x.word))::BIGINT AS last_word,
    coalesce(array_to_string(list_sort(list_distinct(list_transform(b, lambda x: x.label))), ','), '') AS base_labels,
    coalesce(array_to_string(list_sort(list_distinct(list_concat(list_transform(p, lambda x: x.label), coalesce(l, [])))), ','), '') AS labels,
    CASE WHEN l IS NOT NULL THEN 1.0 WHEN len(list_filter(p, lambda x: x.n >= 4)) > 0 THEN 0.9 WHEN len(p) > 0 THEN 0.6 ELSE 0.0 END::DOUBLE AS score
FROM based LEFT JOIN said USING (r)"""


ORACLES["op11_license_scan"] = _op11_sql()


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# Every document scored for every item it shares a term with.
ORACLES["op12_lexical_search"] = r"""
WITH lowered AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
words AS (SELECT r, doc_id, unnest(list_filter(regexp_split_to_array(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term FROM lowered),
tfs AS (SELECT r, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT r, count(*) AS n FROM words GROUP BY r),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tfs, corpus GROUP BY term),
asked AS (SELECT item_id, unnest(list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term FROM benchmark),
often AS (SELECT item_id, term, count(*) AS often FROM asked GROUP BY ALL),
scores AS (SELECT item_id, r, doc_id, sum(often * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::BIGINT AS score
    FROM often JOIN tfs USING (term) JOIN weights USING (term) JOIN lengths USING (r), corpus GROUP BY item_id, r, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10"""


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


# Units as a list of each text.
ORACLES["op13_fill_in_middle"] = """
WITH units AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (SELECT *, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS b,
    ('0x' || substr(h, 17, 8))::BIGINT % 100 AS h3, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS h4 FROM units),
cut AS (SELECT doc_id, t, n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(u[greatest(a, b) + 1:], '') AS s FROM drawn)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256 FROM cut"""
