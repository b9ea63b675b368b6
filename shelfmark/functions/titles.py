"""Column expressions that parse, score and choose title proposals.

All proposals of a project live in one array of its row, so that choosing the
best needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import WS_CHARS, word_runs, words

# Words too general to carry meaning, and terms that cost a point.
GENERIC_WORDS = ("cloud", "integration", "processing", "system", "storage")
GENERIC_TERMS = (
    "smart", "intelligent", "assistant", "hub", "companion", "generic", "solution", "system",
)
GOOD_LENGTH = (3, 5)
LOW_SCORE = 3

TITLES_TYPE = "array<string>"


# One title per line: blanks, a list marker (number or dash with a dot), the title up to
# its last visible character. A line holding only a marker gives none.
_BLANK = r"[\t\x0b-\r\x1c-\x20\x{85}\p{Z}]"
TITLE_LINE = rf"(?md)^{_BLANK}*+(?:[-\p{{Nd}}]+\.{_BLANK}*+)?+([^\n]*[^{WS_CHARS}])"


def title_list(response: Column) -> Column:
    """One title per line without its list number; distinct, first position kept.

    A number or dash counts as a list marker only with a dot after it.
    """
    lines = F.array_distinct(F.regexp_extract_all(response, F.lit(TITLE_LINE), 1))
    return F.coalesce(lines, F.array().cast(TITLES_TYPE))


def context_words(url: Column, summary: Column) -> Column:
    """Distinct words of URL and summary that a good title may repeat."""
    found = word_runs(F.lower(F.concat(url, F.lit(" "), summary)))
    return F.array_distinct(
        F.filter(found, lambda w: ~w.isin(*GENERIC_WORDS) & (F.length(w) > 2))
    )


def title_parts(title: Column) -> Column:
    """What the score looks at, taken out of a title once."""
    low = F.lower(title)
    return F.struct(
        title.alias("title"), low.alias("low"), words(low).alias("tokens"), word_runs(low).alias("runs")
    )


def score_of(parts: Column, context: Column) -> Column:
    title, low, runs = parts["title"], parts["low"], parts["runs"]
    n = F.size(parts["tokens"])
    specific = F.size(F.filter(runs, lambda w: ~w.isin(*GENERIC_WORDS)))
    repeated = F.size(F.filter(parts["tokens"], lambda w: F.array_contains(context, w)))
    penalties = sum((low.contains(t).cast("int") for t in GENERIC_TERMS), F.lit(0))
    return (
        F.when(n.between(*GOOD_LENGTH), 2).otherwise(-1)
        + repeated
        - penalties
        - F.when(specific < 2, 2).otherwise(0)
        - F.when(F.coalesce(F.get(runs, 0).isin(*GENERIC_WORDS), F.lit(False)), 1).otherwise(0)
        + F.when(title.contains(":") | title.contains("-"), 1).otherwise(0)
    )


def title_score(title: Column, context: Column) -> Column:
    return score_of(title_parts(title), context)


def scored_titles(titles: Column, context: Column) -> Column:
    """array<struct<title, score>> in the order of the titles.

    The context is bound to a variable of an outer one-element transform. As a
    column it could be merged into the inner functions, and then its words would
    be looked for again for every word of every title.
    """
    scored = lambda known: F.transform(
        F.transform(titles, title_parts),
        lambda p: F.struct(
            p["title"].alias("title"), score_of(p, known).cast("int").alias("score")
        ),
    )
    return F.get(F.transform(F.array(context), scored), 0)


def merged_scores(old: Column, new: Column) -> Column:
    """New proposals after the old ones; a repeated title keeps its first place."""
    return F.array_distinct(F.concat(old, new))


def best_title(scored: Column) -> Column:
    """struct<score, back, title> of the highest score; the earliest wins a tie; null for no titles."""
    ranked = F.transform(
        scored,
        lambda s, i: F.struct(s["score"].alias("score"), (-i).alias("back"), s["title"].alias("title")),
    )
    return F.array_max(ranked)


# Fixed value: the sentence that reports the best title.
FEEDBACK = "The best title is '%s' with a score of %d."


def feedback(best: Column) -> Column:
    return F.format_string(FEEDBACK, best["title"], best["score"])


def without_marks(c: Column) -> Column:
    """Drop double quotes and the words 'Title: ' wherever they stand."""
    return F.replace(F.replace(c, F.lit('"'), F.lit("")), F.lit("Title: "), F.lit(""))


# Replacements of the README-only enrichment, in this order.
WORDING = (("Predictor", "Prediction"), ("Detection", "Prediction"), ("Classifier", "Classification"))


def uniform_wording(c: Column) -> Column:
    c = F.replace(c, F.lit('"'), F.lit(""))
    for old, new in WORDING:
        c = F.replace(c, F.lit(old), F.lit(new))
    return F.replace(c, F.lit("Title: "), F.lit(""))
