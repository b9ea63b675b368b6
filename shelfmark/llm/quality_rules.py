"""Quality rules on texts, and verdicts on the hosts they come from. Native columns only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import SPACES, stored

SYMBOLS = "#*$%&|<>"
#: Names of the rules beside their conditions; a text fails a rule when its condition holds.
RULES: dict[str, str] = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 10 * word_chars",
    "lines": "100 * n_dup_lines > 50 * n_lines",
}
BASE_RULES = ("short", "repeats")


def _repeated(windows: Column, size: int) -> Column:
    """Words covered by windows that occur twice or more; `windows` is sorted (hash, place) pairs."""
    same = lambda i, j: windows[i]["h"] == windows[j]["h"]
    again = F.filter(
        windows,
        lambda _, i: ((i > 0) & same(F.greatest(i - 1, F.lit(0)), i))
        | ((i + 1 < F.size(windows)) & same(F.least(i + 1, F.size(windows) - 1), i)),
    )
    places = F.sort_array(F.transform(again, lambda w: w["i"]))
    start = F.struct(F.lit(-size).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        places,
        start,
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(size), i - a["last"])).alias("n")),
        lambda a: a["n"],
    )


def text_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with the counts that the rules look at; the text itself goes.

    n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines and
    n_repeat_words (words inside 3-word windows found twice or more). A null or
    blank text counts nothing. Windows are compared by 64-bit hashes within one text,
    sorted with their places only where a text has a repeated one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    word_space = f"[{SPACES}]+".replace("\x20\x09\x0a\x0b\x0c\x0d", "\\x20\\x09-\\x0D")
    solid = F.btrim(text, F.lit(SPACES))
    step = docs.select(
        *[c for c in docs.columns if c != text_col],
        F.when(solid == "", F.array().cast("array<string>")).otherwise(F.split(solid, word_space)).alias("_w"),
        F.char_length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "").alias("_l"),
    )
    step = step.withColumns(
        {
            "n_words": F.size("_w").cast("long"),
            "n_lines": F.size("_l").cast("long"),
            "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
            "_h": F.when(
                F.size("_w") >= 3,
                F.transform(
                    F.sequence(F.lit(1), F.size("_w") - 2),
                    lambda i: F.xxhash64(F.element_at("_w", i), F.element_at("_w", i + 1), F.element_at("_w", i + 2)),
                ),
            ).otherwise(F.array().cast("array<bigint>")),
        }
    )
    step = step.withColumn(
        "_s",
        F.when(
            F.size(F.array_distinct("_h")) < F.size("_h"),
            F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    step = step.withColumn("n_repeat_words", F.coalesce(_repeated(F.col("_s"), 3), F.lit(0)).cast("long"))
    return step.drop("_w", "_l", "_h", "_s")


def host_rates(failed: DataFrame, host_col: str, rules: list[str]) -> DataFrame:
    """For each host: documents, and the failure rate of each rule shrunk to the mean of all hosts.

    The prior of a rule is a beta distribution fitted by moments to the hosts' own
    rates, less what chance alone would spread them; hosts with few documents move
    most. One host, or hosts that all agree, give a strong prior.
    """
    hosts = failed.groupBy(host_col).agg(
        F.count("*").alias("host_docs"), *[F.sum(F.col(f"fails_{r}").cast("long")).alias(f"_f_{r}") for r in rules]
    )
    hosts = stored(hosts)
    prior = []
    for r in rules:
        rate = F.col(f"_f_{r}") / F.col("host_docs")
        prior += [
            F.avg(rate).alias(f"m_{r}"),
            (F.var_pop(rate) - F.avg(rate * (1 - rate) / F.col("host_docs"))).alias(f"v_{r}"),
        ]
    moments = hosts.agg(F.struct(*prior).alias("p")).scalar()
    hosts = hosts.withColumn("_p", moments)
    for r in rules:
        mean, var = F.col(f"_p.m_{r}"), F.greatest(F.col(f"_p.v_{r}"), F.lit(1e-9))
        weight = F.least(F.greatest(mean * (1 - mean) / var - 1, F.lit(1.0)), F.lit(1e6))
        hosts = hosts.withColumn(f"rate_{r}", (F.col(f"_f_{r}") + mean * weight) / (F.col("host_docs") + weight))
    return hosts.drop("_p", *[f"_f_{r}" for r in rules])


def quality_rules(
    docs: DataFrame,
    host_col: str = "source",
    rules: dict[str, str] = RULES,
    base: tuple[str, ...] = BASE_RULES,
    max_rate: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Counts, failed rules, the host's shrunk rates and the verdict of every document.

    A document is kept when it fails no rule itself and its host's shrunk failure
    rate is at most `max_rate` for every rule. A null host is a host of its own.
    Repeated rows count and return each; a null id stays; an empty table gives an
    empty one. Other columns are dropped first, so their names cannot clash.
    The hosts are aggregated with partial sums, so a host with most rows is no burden.
    """
    lean = docs.select(docs[id_col].alias("_id"), docs[host_col].alias("_host"), docs[text_col].alias("_text"))
    counts = text_counts(lean, "_text")
    counts = counts.withColumns({f"fails_{r}": F.expr(c) for r, c in rules.items()})
    counts = stored(counts)
    rates = host_rates(counts.withColumnRenamed("_host", "_key"), "_key", list(rules))
    out = counts.join(rates, F.col("_host").eqNullSafe(F.col("_key")))
    any_of = lambda names: F.greatest(*[F.col(n) for n in names]) if len(names) > 1 else F.col(names[0])
    return out.select(
        F.col("_id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        any_of([f"fails_{r}" for r in base]).alias("base_failed"),
        *[f"fails_{r}" for r in rules],
        "host_docs",
        *[f"rate_{r}" for r in rules],
        (~any_of([f"fails_{r}" for r in rules]) & (any_of([f"rate_{r}" for r in rules]) <= max_rate)).alias("kept"),
    )
