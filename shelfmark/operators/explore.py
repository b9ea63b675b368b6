"""Filters, counts, pivots and word statistics over the catalogue.

Counts leave nulls of their keys out, as the counts of the exploration view do;
ties come in the order of the value. Every count is combined per partition
before its shuffle, so a value held by most rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.text import STOP_WORDS, content_words

TITLE = "project_title"
CATEGORY_LIMIT = 10


# ---------------------------------------------------------------- filters


def hide_unknown(df: DataFrame, col: str = TITLE) -> DataFrame:
    """Rows with any title but 'Unknown'; a null title stays."""
    return df.where(~F.col(col).eqNullSafe(F.lit("Unknown")))


def only_unknown(df: DataFrame, col: str = TITLE) -> DataFrame:
    return df.where(F.col(col) == "Unknown")


def known_titles(df: DataFrame, hide: bool = True, only: bool = False) -> DataFrame:
    """The two switches together; setting both filters nothing."""
    if hide == only:
        return df
    return hide_unknown(df) if hide else only_unknown(df)


@dataclass(frozen=True)
class OneOf:
    """Keep the listed values; None in the list keeps null."""

    values: Sequence[Any]

    def test(self, c: Column) -> Column:
        given = [v for v in self.values if v is not None]
        kept = F.coalesce(c.isin(*given), F.lit(False)) if given else F.lit(False)
        return kept | c.isNull() if len(given) < len(self.values) else kept


@dataclass(frozen=True)
class InRange:
    """Keep low <= value <= high; null never lies in a range. Open ends are None."""

    low: float | None = None
    high: float | None = None

    def test(self, c: Column) -> Column:
        kept = c.isNotNull() & ~F.isnan(c.cast("double"))
        kept = kept & (c >= self.low) if self.low is not None else kept
        return kept & (c <= self.high) if self.high is not None else kept


@dataclass(frozen=True)
class Matches:
    """Keep values in which the pattern is found; null is never a match."""

    pattern: str
    case_sensitive: bool = False

    def test(self, c: Column) -> Column:
        flags = "" if self.case_sensitive else "(?iu)"
        return F.coalesce(c.cast("string").rlike(flags + self.pattern), F.lit(False))


def where(df: DataFrame, **specs: OneOf | InRange | Matches) -> DataFrame:
    """All filters in one step, when their kinds are known beforehand."""
    for name, spec in specs.items():
        df = df.where(spec.test(F.col(name)))
    return df


#: A sketch of distinct values holds this many hashes (as a power of two); up to there its count is exact.
SKETCH = 12


def distinct_sketch(col: str, log_size: int = SKETCH) -> Column:
    """A mergeable sketch of the distinct values of a column of any plain type, nulls not counted; bounded in size."""
    value = F.when(F.col(col).isNotNull(), F.xxhash64(F.col(col)))
    return F.theta_sketch_estimate(F.theta_sketch_agg(value, log_size))


def few_values(df: DataFrame, cols: Sequence[str], limit: int = CATEGORY_LIMIT) -> dict[str, bool]:
    """Whether each column has fewer than `limit` distinct values, nulls not counted: one pass for all, exact.

    Each column is one bounded sketch per task, so rows are neither copied per column nor shuffled by value.
    """
    if not cols:
        return {}
    log_size = max(4, (limit - 1).bit_length() + 1)
    found = df.agg(*[distinct_sketch(c, log_size).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    return {c: (found[i] or 0) < limit for i, c in enumerate(cols)}


def filter_chain(
    df: DataFrame,
    specs: Mapping[str, Any] | None = None,
    hide: bool = True,
    only: bool = False,
    skip: Sequence[str] = ("course", "year"),
    case_sensitive: bool = False,
) -> DataFrame:
    """Column filters whose kind follows from the rows left by the filters before.

    Fewer than ten distinct values make a list of values, else a number makes a
    (low, high) range and anything else a pattern. A column without an entry in
    `specs` has everything selected, which for a range means that nulls go.
    List-valued columns are passed over. Entries of the three filter classes
    say their kind themselves and cost no look at the data.

    One pass tells the kinds of all columns that are still to come. Filters only make values fewer, so a
    column with few keeps them; the others are looked at again, together, once a filter has changed the rows.
    """
    specs = dict(specs or {})
    unknown = set(specs) - set(df.columns)
    if unknown:
        raise ValueError(f"no such column: {sorted(unknown)}")
    out = known_titles(df, hide, only)
    fields = [f for f in df.schema.fields if f.name not in skip and not _nested(f.dataType)]
    numeric = {f.name for f in fields if isinstance(f.dataType, T.NumericType)}
    # A number without an entry only loses its missing values: without any, its kind is moot.
    open_ranges = [c for c in numeric if specs.get(c) is None]
    gaps = _with_missing(out, open_ranges) if open_ranges else set()
    named = (OneOf, InRange, Matches)
    asked = [f.name for f in fields if not isinstance(specs.get(f.name), named) and (specs.get(f.name) is not None or f.name in gaps)]
    few: dict[str, bool] = {}
    changed = True
    for name in (f.name for f in fields):
        spec = specs.get(name)
        if not isinstance(spec, named):
            if name not in asked:
                continue
            if changed and not few.get(name):
                left = [c for c in asked[asked.index(name) :] if not few.get(c)]
                few.update(few_values(out, left))
                changed = False
            if few[name]:
                spec = None if spec is None else OneOf(spec)
            elif name in numeric:
                spec = InRange(*(spec or ()))
            else:
                spec = Matches(spec, case_sensitive) if spec else None
        if spec is not None:
            out = out.where(spec.test(F.col(name)))
            changed = True
    return out


def _nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ArrayType, T.MapType, T.StructType))


def _with_missing(df: DataFrame, cols: Sequence[str]) -> set[str]:
    """Which of the numeric columns hold a missing value, found in one pass."""
    gap = lambda c: F.coalesce(F.isnan(F.col(c).cast("double")), F.lit(True)) | F.col(c).isNull()
    found = df.agg(*[F.bool_or(gap(c)).alias(c) for c in cols]).first()
    return {c for c in cols if found[c]}


def range_bounds(df: DataFrame, col: str, steps: int = 100) -> DataFrame:
    """Smallest and largest value and the step of a slider between them."""
    low, high = F.min(col).cast("double"), F.max(col).cast("double")
    return df.agg(low.alias("low"), high.alias("high"), ((high - low) / steps).alias("step"))


def profile(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """One row per column with distinct count, smallest and largest value as text.

    All columns are read in one pass of bounded sketches, whose counts are exact for columns of up to some thousand
    values. With `exact`, each column with more is then counted by itself, from its own values alone.
    """
    measures = [
        m
        for i, c in enumerate(cols)
        for m in (
            distinct_sketch(c).alias(f"n{i}"),
            F.min(c).cast("string").alias(f"min{i}"),
            F.max(c).cast("string").alias(f"max{i}"),
        )
    ]
    found = df.agg(*measures).first()
    kind = "column string, n_distinct long, min string, max string"
    rows = [(c, found[f"n{i}"] or 0, found[f"min{i}"], found[f"max{i}"]) for i, c in enumerate(cols)]
    many = {c for c, n, _, _ in rows if exact and n >= 1 << SKETCH}
    out = df.sparkSession.createDataFrame([r for r in rows if r[0] not in many], kind)
    for c, _, low, high in rows:
        if c in many:
            count = df.agg(F.count_distinct(c).alias("n_distinct"))
            ends = (F.lit(low).cast("string").alias("min"), F.lit(high).cast("string").alias("max"))
            out = out.unionByName(count.select(F.lit(c).alias("column"), "n_distinct", *ends))
    return out


# ---------------------------------------------------------------- counts


def counts(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """How often each value occurs, most frequent first; the first n if given."""
    found = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    ordered = found.orderBy(F.desc("n"), F.asc(col))
    return ordered if n is None else ordered.limit(n)


def shares(df: DataFrame, col: str) -> DataFrame:
    """Counts with their share of the total, which is a scalar subquery over the counts."""
    found = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = found.agg(F.sum("n")).scalar()
    return found.withColumn("share", F.col("n") / total).orderBy(F.desc("n"), F.asc(col))


def count_pivot(df: DataFrame, row: str, col: str, values: Sequence[str]) -> DataFrame:
    """Count per row value and column value, 0 where a pair does not occur.

    The column values are given, which fixes the schema and saves a job to find
    them; rows with another value are not counted.
    """
    listed = df.where(F.col(row).isNotNull() & F.col(col).isin(*values))
    cells = [F.count_if(F.col(col) == v).alias(v) for v in values]
    return listed.groupBy(row).agg(*cells)


def pair_counts(df: DataFrame, row: str, col: str) -> DataFrame:
    keyed = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    return keyed.groupBy(row, col).agg(F.count(F.lit(1)).alias("n"))


def stacked(df: DataFrame, row: str, col: str, values: Sequence[str] | None = None) -> DataFrame:
    """Stacked bars: each part with the height it starts at and the total of its bar.

    Parts are stacked in falling order of their overall count. The windows run
    over one counted row per bar and part, never over the table.
    """
    parts = pair_counts(df, row, col)
    if values is not None:
        parts = parts.where(F.col(col).isin(*values))
    order = parts.groupBy(col).agg(F.sum("n").alias("_size"))
    bar = Window.partitionBy(row)
    below = bar.orderBy(F.desc("_size"), F.asc(col)).rowsBetween(Window.unboundedPreceding, -1)
    return parts.join(order, col).select(
        row,
        col,
        "n",
        F.coalesce(F.sum("n").over(below), F.lit(0)).alias("base"),
        F.sum("n").over(bar).alias("total"),
    )


def pivot_totals(pivot: DataFrame, row: str) -> DataFrame:
    """Total per bar of a pivot."""
    cells = [F.col(c) for c in pivot.columns if c != row]
    return pivot.withColumn("total", sum(cells[1:], cells[0]))


# ---------------------------------------------------------------- words


def with_text_titles(df: DataFrame, legacy_nan: bool = True) -> DataFrame:
    """Titles as the exploration view shows them: a missing one is the text 'nan'."""
    return df.withColumn(TITLE, F.coalesce(TITLE, F.lit("nan"))) if legacy_nan else df


#: Partitions over which one word is dealt when words are looked up.
SALTS = 8


def preprocess(
    df: DataFrame,
    col: str = TITLE,
    stop_words: Sequence[str] = STOP_WORDS,
    lemmas: DataFrame | None = None,
    key: str | None = None,
    out: str = "processed_titles",
) -> DataFrame:
    """Add the content words of a text column as an array.

    Without `lemmas` this is one projection. With a table (form, lemma), unique
    by form, words are looked up by a join and gathered again by the unique
    `key`; each group is as long as one text. For word counts give the lemmas
    to `word_counts` instead, which looks each distinct word up once.
    """
    tokens = content_words(F.col(col), stop_words)
    if lemmas is None:
        return df.withColumn(out, tokens)
    if key is None:
        raise ValueError("lemmas need the name of a unique key")
    exploded = df.select(key, F.posexplode_outer(tokens).alias("_pos", "form")).where(
        F.col("form").isNotNull()
    )
    # Few words make up much of any text: each is dealt over several partitions.
    salted = exploded.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int"))
    spread = lemmas.select("form", "lemma", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    looked_up = salted.join(spread, ["form", "_salt"], "left")
    gathered = looked_up.groupBy(key).agg(
        F.sort_array(
            F.collect_list(F.struct("_pos", F.coalesce("lemma", "form").alias("word")))
        ).alias("_words")
    )
    empty = F.when(F.col(col).isNotNull(), F.array().cast("array<string>"))
    return (
        df.join(gathered, key, "left")
        .withColumn(out, F.coalesce(F.col("_words.word"), empty))
        .drop("_words")
    )


def word_counts(
    df: DataFrame,
    col: str = "processed_titles",
    lemmas: DataFrame | None = None,
    n: int | None = None,
) -> DataFrame:
    """How often each word occurs over all arrays, most frequent first.

    Words are counted before they are looked up, so the join and the second sum
    work on distinct words.
    """
    # The outer explode keeps Spark from filtering on the array, which would build it twice.
    forms = df.select(F.explode_outer(col).alias("form")).where(F.col("form").isNotNull())
    found = forms.groupBy("form").agg(F.count(F.lit(1)).alias("n"))
    if lemmas is not None:
        looked_up = found.join(lemmas.select("form", "lemma"), "form", "left")
        named = looked_up.select(F.coalesce("lemma", "form").alias("word"), "n")
        found = named.groupBy("word").agg(F.sum("n").alias("n"))
    else:
        found = found.withColumnRenamed("form", "word")
    ordered = found.orderBy(F.desc("n"), F.asc("word"))
    return ordered if n is None else ordered.limit(n)


def term_weights(
    df: DataFrame, col: str = "processed_titles", lemmas: DataFrame | None = None, n: int = 100
) -> DataFrame:
    """The n most frequent words with their weight relative to the most frequent one."""
    top = word_counts(df, col, lemmas, n)
    return top.withColumn("weight", F.col("n") / F.max("n").over(Window.partitionBy(F.lit(0))))


# ---------------------------------------------------------------- numbers


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Rows per bin of equal width between smallest and largest value; text gives counts.

    The bounds are scalar subqueries, so nothing is joined. Empty bins are
    listed, and equal bounds put all rows into the first bin.
    """
    if isinstance(df.schema[col].dataType, T.StringType):
        return counts(df, col)
    value = F.col(col).cast("double")
    numbers = df.where(value.isNotNull() & ~F.isnan(value)).select(value.alias("v"))
    low, high = numbers.agg(F.min("v")).scalar(), numbers.agg(F.max("v")).scalar()
    width = F.when(high > low, (high - low) / bins).otherwise(F.lit(1.0))
    index = F.least(F.floor((F.col("v") - low) / width) + 1, F.lit(bins)).cast("int")
    filled = numbers.groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    axis = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return axis.join(filled, "bin", "left").select(
        "bin",
        (low + (F.col("bin") - 1) * width).alias("low"),
        (low + F.col("bin") * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def correlations(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of numeric columns, over rows complete for the pair.

    All pairs of columns are computed in one pass over the rows.
    """
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    measured = df.agg(
        *[
            F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    rows = [
        F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"c{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
        for x, y in dict.fromkeys([(a, b), (b, a)])
    ]
    return measured.select(F.inline(F.array(*rows)))
