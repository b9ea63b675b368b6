"""Which catalogue rows need work, what becomes of each, and how results return.

Catalogue rows are `(project_url, project_title, deployment_type, reason,
cloud)`, unique by URL. Joins on the URL treat null as a value: a cleaned list
may hold one null URL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.text import known, strip
from shelfmark.operators.clean import KEY, RESULT_COLUMNS, with_result_columns

# The reasons and notes that later runs look for.
NOT_FOUND_MARK = "404:"
NOT_FOUND_REASON = "404: Repository not found (may be deleted or private)"
NO_FILES_REASON = "No files fetched"
NOTE_NO_TITLES = " | Title: LLM returned no titles"
NOTE_NO_SUMMARY = " | Title: LLM summary failed"

NO_URL = "project URL is missing"
NO_REASON = "no reason to append the title note to"


def key_columns(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def catalogue_key(df: DataFrame) -> list[str]:
    """What names a row of a catalogue: the URL, within its course and year where there are such columns."""
    return [*[c for c in ("course", "year") if c in df.columns], KEY]


def first_per_key(df: DataFrame, order_by: Sequence[str | Column], key: str | Sequence[str] = KEY) -> DataFrame:
    """The first row of each key; the cut happens before the shuffle, so hot keys stay small.

    Grouped by the two expressions a null-safe join hashes a column by, so that such a
    join on the key needs no further shuffle of this side.
    """
    by = [e for k in key_columns(key) for e in (F.coalesce(F.col(k).cast("string"), F.lit("")), F.isnull(F.col(k)))]
    order = Window.partitionBy(*by).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def keyed(df: DataFrame, key: str | Sequence[str], side: str) -> list[Column]:
    """The key columns of one side of a join, under names of their own."""
    return [F.col(k).alias(f"_{side}{i}") for i, k in enumerate(key_columns(key))]


def same_key(key: str | Sequence[str], side: str) -> Column:
    """Whether the key columns equal those `keyed` has named; null is a value."""
    alike = [F.col(k).eqNullSafe(F.col(f"_{side}{i}")) for i, k in enumerate(key_columns(key))]
    return reduce(lambda a, b: a & b, alike)


def carry_enrichment(
    cleaned: DataFrame,
    old: DataFrame,
    cols: Sequence[str] = RESULT_COLUMNS,
    order_by: Sequence[str | Column] = RESULT_COLUMNS,
    key: str | Sequence[str] = KEY,
) -> DataFrame:
    """Give the cleaned list the results of an earlier catalogue; old keys not listed vanish.

    A key several times in the old catalogue counts by its first row in the
    given order. The key may be of several columns: `catalogue_key` names those of a list.
    """
    present = [c for c in cols if c in old.columns]
    first = first_per_key(old, order_by, key).select(
        *keyed(old, key, "k"), *[F.col(c).alias(f"_{c}") for c in present]
    )
    kept = [c for c in cleaned.columns if c not in present]
    joined = cleaned.join(first, same_key(key, "k"), "left")
    carried = joined.select(*kept, *[F.col(f"_{c}").alias(c) for c in present])
    return with_result_columns(carried, cols)


# ---------------------------------------------------------------- predicates


def _not_found_before(reason: Column) -> Column:
    return F.coalesce(reason.startswith(NOT_FOUND_MARK), F.lit(False))


def needs_processing(force: Column | bool = False) -> Column:
    """Not gone for good, and forced or without a usable title or deployment type."""
    force = F.lit(force) if isinstance(force, bool) else force
    done = known(F.col("project_title")) & known(F.col("deployment_type"))
    return ~_not_found_before(F.col("reason")) & (force | ~done)


def needs_classification(force: Column | bool = False) -> Column:
    """Forced, no deployment type, or 'unknown'; an 'Error' is kept as it is."""
    force = F.lit(force) if isinstance(force, bool) else force
    kind = F.col("deployment_type")
    return force | kind.isNull() | F.coalesce(F.lower(strip(kind)) == "unknown", F.lit(False))


def needs_title(force: Column | bool = False) -> Column:
    force = F.lit(force) if isinstance(force, bool) else force
    no_files = F.lower("reason").contains(NO_FILES_REASON.lower())
    return force | ~known(F.col("project_title")) | F.coalesce(no_files, F.lit(False))


def with_needs(df: DataFrame, force: Column | bool = False) -> DataFrame:
    return df.withColumns(
        {
            "needs_processing": needs_processing(force),
            "needs_classification": needs_classification(force),
            "needs_title": needs_title(force),
        }
    )


def single_project(df: DataFrame, url: str, key: str = KEY) -> DataFrame:
    """The rows of one project, trailing slashes of the URL ignored."""
    return df.where(F.rtrim(F.col(key), F.lit("/")) == url.rstrip("/"))


def work_limit(df: DataFrame, n: int, order_by: Sequence[str] = (KEY,)) -> DataFrame:
    """The first n rows of the order; 0 means all."""
    return df.orderBy(*order_by).limit(n) if n > 0 else df


# ---------------------------------------------------------------- states

STATE_TYPE = (
    "struct<project_title:string,deployment_type:string,reason:string,cloud:string,status:string>"
)


def _state(title, deployment, reason, cloud, status) -> Column:
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    names = (*RESULT_COLUMNS, "status")
    values = (title, deployment, reason, cloud, status)
    return F.struct(*[as_col(v).alias(n) for v, n in zip(values, names)]).cast(STATE_TYPE)


def result_state(force: Column | bool = False) -> Column:
    """What becomes of a row, as struct<title, type, reason, cloud, status>.

    Reads the catalogue columns and what is known about the repository:
    `not_found`, `has_files`; the parsed answer `new_type`, `new_reason`,
    `new_cloud`; `summary` and `new_title`, null or empty where the model gave
    none; and `failure`, the text of a failed step or null.

    A row that is gone for good, or complete, is skipped unchanged. A title that
    cannot be had is noted in the reason; without a reason to note it in, the
    row is an error. An error keeps the title it has.
    """
    title, kind = F.col("project_title"), F.col("deployment_type")
    reason, cloud = F.col("reason"), F.col("cloud")
    classify = needs_classification(force)
    type_now = F.when(classify, F.col("new_type")).otherwise(kind)
    reason_now = F.when(classify, F.col("new_reason")).otherwise(reason)
    cloud_now = F.when(classify, F.col("new_cloud")).otherwise(cloud)

    got_summary = F.coalesce(F.col("summary"), F.lit("")) != ""
    note = F.when(~got_summary, NOTE_NO_SUMMARY).when(F.col("new_title").isNull(), NOTE_NO_TITLES)
    noted = needs_title(force) & note.isNotNull()
    kept_title = F.coalesce(F.nullif(title, F.lit("")), F.lit("Error"))
    error = lambda t, why: _state(t, "Error", F.substring(why, 1, 100), "Error", "error")

    return (
        F.when(~needs_processing(force), _state(title, kind, reason, cloud, "skip"))
        .when(F.col(KEY).isNull(), error(kept_title, F.lit(NO_URL)))
        .when(F.col("failure").isNotNull(), error(kept_title, F.col("failure")))
        .when(F.col("not_found"), _state("Unknown", "Unknown", NOT_FOUND_REASON, "Unknown", "skip"))
        .when(~F.col("has_files"), _state("Unknown", "Unknown", NO_FILES_REASON, "Unknown", "skip"))
        .when(noted & reason_now.isNull(), error(F.lit("Unknown"), F.lit(NO_REASON)))
        .when(noted, _state("Unknown", type_now, F.concat(reason_now, note), cloud_now, "success"))
        .otherwise(
            _state(
                F.when(needs_title(force), F.col("new_title")).otherwise(title),
                type_now,
                reason_now,
                cloud_now,
                "success",
            )
        )
    )


def apply_states(df: DataFrame, force: Column | bool = False) -> DataFrame:
    """Replace the result columns by the outcome of each row and add `status`."""
    kept = [c for c in df.columns if c not in (*RESULT_COLUMNS, "status")]
    return df.withColumn("_state", result_state(force)).select(*kept, "_state.*")


# ---------------------------------------------------------------- results


def merge_results(
    df: DataFrame, results: DataFrame, cols: Sequence[str] = RESULT_COLUMNS, key: str | Sequence[str] = KEY
) -> DataFrame:
    """Write results over the rows they belong to; other rows stay.

    A result overwrites with its nulls too. Of several results of one key (null is one) the first by its values
    counts, so that no row is multiplied.
    """
    cols = [c for c in cols if c in results.columns]
    once = first_per_key(results, [F.asc_nulls_last(c) for c in cols] or [F.lit(1)], key)
    new = once.select(*keyed(results, key, "k"), F.lit(True).alias("_has"), *[F.col(c).alias(f"_{c}") for c in cols])
    joined = df.join(new, same_key(key, "k"), "left")
    merged = {
        c: F.when(F.col("_has"), F.col(f"_{c}")).otherwise(
            F.col(c) if c in df.columns else F.lit(None)
        )
        for c in cols
    }
    return joined.withColumns(merged).select(*dict.fromkeys([*df.columns, *cols]))


def retry(df: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run the rows in error once more, forced, in place of their first results.

    `step` takes the rows without their status and returns each of them with new
    results and status. Rows not in error keep theirs. Nothing runs where no row failed,
    which a look for the first failed row tells. `df` is read for that and for
    both parts: checkpoint it first when it is costly.
    """
    in_error = F.coalesce(F.col("status") == "error", F.lit(False))
    failed = df.where(in_error)
    if not failed.head(1):
        return df
    again = step(failed.drop("status"))
    return df.where(~in_error).unionByName(again.select(*df.columns))


def retry_states(df: DataFrame, failure: str = "failure") -> DataFrame:
    """`apply_states`, and for rows in error once more, forced and without the failure of the first time, in one pass.

    For steps whose facts stand in the row already: both outcomes are expressions over it, so the rows are
    read once, and a row is worked out a second time only where it failed.
    """
    first = df.withColumn("_state", result_state())
    kept = [c for c in df.columns if c not in (*RESULT_COLUMNS, "status", failure)]
    results = [F.col(f"_state.{c}").alias(c) for c in RESULT_COLUMNS]
    again = first.select(*kept, "_state", *results, F.lit(None).cast("string").alias(failure))
    last = F.when(F.col("_state.status") == "error", result_state(True)).otherwise(F.col("_state"))
    return again.select(*kept, last.alias("_last")).select(*kept, "_last.*")


def status_counts(df: DataFrame) -> DataFrame:
    """Rows per status as one row; a retried row counts by its last status."""
    names = ("success", "skip", "error")
    return df.agg(*[F.count_if(F.col("status") == s).alias(s) for s in names])


def run_metrics(df: DataFrame, seconds: float) -> DataFrame:
    """Status counts, total and rows per second, 0 where no time passed."""
    total = F.col("success") + F.col("skip") + F.col("error")
    counted = status_counts(df).withColumn("total", total)
    rate = F.coalesce(F.try_divide(F.col("total"), F.lit(float(seconds))), F.lit(0.0))
    return counted.withColumn("rows_per_second", rate)


def changes(before: Sequence[Column], after: Sequence[Column], cols: Sequence[str] = RESULT_COLUMNS) -> Column:
    """The names of the result columns whose values differ; null is a value."""
    return F.array_compact(F.array(*[F.when(~a.eqNullSafe(b), c) for a, b, c in zip(before, after, cols)]))


def changed_rows(
    old: DataFrame, new: DataFrame, cols: Sequence[str] = RESULT_COLUMNS, key: str | Sequence[str] = KEY
) -> DataFrame:
    """Rows whose results differ between two tables: key, names of the changed columns, old and new values.

    Keys are unique in the new table; of the old one the first row of a key by its values counts. Where old values
    stand beside the new ones, `changed_states` needs no join.
    """
    names = key_columns(key)
    once = first_per_key(old, [F.asc_nulls_last(c) for c in cols], key)
    before = once.select(*keyed(old, key, "k"), *[F.col(c).alias(f"old_{c}") for c in cols])
    after = new.select(*names, *[F.col(c).alias(f"new_{c}") for c in cols])
    met = after.join(before, same_key(key, "k")).drop(*[f"_k{i}" for i in range(len(names))])
    changed = changes([F.col(f"old_{c}") for c in cols], [F.col(f"new_{c}") for c in cols], cols)
    return met.withColumn("changed", changed).where(F.size("changed") > 0)


def changed_states(df: DataFrame, force: Column | bool = False, key: str | Sequence[str] = KEY) -> DataFrame:
    """What `apply_states` would change, from the rows it would be given: their own results are the old ones.

    The same columns as `changed_rows`, in one pass without a join.
    """
    cols = list(RESULT_COLUMNS)
    state = df.withColumn("_state", result_state(force))
    changed = changes([F.col(c) for c in cols], [F.col(f"_state.{c}") for c in cols], cols)
    old, new = [F.col(c).alias(f"old_{c}") for c in cols], [F.col(f"_state.{c}").alias(f"new_{c}") for c in cols]
    return state.select(*key_columns(key), *new, *old, changed.alias("changed")).where(F.size("changed") > 0)
