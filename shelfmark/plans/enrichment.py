"""Whole enrichment jobs over a catalogue, composed of the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.answers import summary_of
from shelfmark.functions.text import cut
from shelfmark.functions.urls import readme_slug, sanitized
from shelfmark.operators import answers as ans
from shelfmark.operators import repos
from shelfmark.operators.clean import (
    KEY,
    RESULT_COLUMNS,
    clean_titles,
    normalise_titles,
    repair_mojibake,
    with_result_columns,
)
from shelfmark.operators.courses import with_valid_types
from shelfmark.operators.enrich import (
    apply_states,
    carry_enrichment,
    catalogue_key,
    changed_rows,
    merge_results,
    needs_classification,
    needs_processing,
    needs_title,
    retry,
    single_project,
    work_limit,
)
from shelfmark.operators.titles import (
    best_titles,
    parse_titles,
    score_titles,
    summary_requests,
    title_requests,
    to_regenerate,
    with_second_answers,
)
from shelfmark.operators.urls import parse_repo_url
from shelfmark.session import reliable


#: The name of a row within a run.
ROW = "_row_key"


class Answers:
    """Where the answers of a run come from: a model and the table that keeps its answers.

    `scratch` holds checkpoints where the session names no checkpoint folder.
    """

    def __init__(
        self,
        model: ans.Model,
        path: str,
        max_parallel: int = 8,
        scratch: str | None = None,
        slice_size: int = 64,
    ):
        self.model, self.path, self.max_parallel = model, path, max_parallel
        self.scratch, self.slice_size = scratch, slice_size

    def of(self, requests: DataFrame) -> DataFrame:
        """Requests with their answers, checkpointed: the next requests build on them."""
        answered = ans.stored_answers(
            requests, self.model, self.path, self.max_parallel, self.slice_size
        )
        return self.keep(answered.drop("prompt"))

    def keep(self, df: DataFrame) -> DataFrame:
        """A table that later steps read several times, with its lineage cut."""
        return reliable(df, self.scratch)


class DirectAnswers:
    """Answers of a cheap, deterministic model: asked where they are needed and kept nowhere, so nothing is written.

    For `enrich_from_readme`. `enrich` reads each of its steps several times, which without a cut in
    lineage grows into a plan too large to run: it needs `Answers`.
    """

    def __init__(self, model: ans.Model):
        self.model = model

    def of(self, requests: DataFrame) -> DataFrame:
        hashed = ans.with_request_hash(requests)
        given = ans.infer(hashed.select("request_hash", "prompt"), self.model)
        return hashed.join(given, "request_hash", "left").drop("request_hash", "prompt")

    def keep(self, df: DataFrame) -> DataFrame:
        return df


def enrich(
    catalogue: DataFrame,
    trees: DataFrame,
    contents: DataFrame,
    status: DataFrame,
    answers: Answers,
    types: Mapping[str, Sequence[str]] | None = None,
    force: bool = False,
) -> DataFrame:
    """Title, deployment type, reason and cloud of every row that needs them, with a status.

    Rows that need nothing pass by untouched: they take no part in any join.
    `catalogue` is `(project_url, [course, year], result columns)`, unique by course, year and URL.
    The gathered texts are checkpointed, since every request reads them again.
    """
    rows = with_result_columns(catalogue)
    # A row is named by course, year and URL: the same URL may be handed in again another year.
    work = rows.where(needs_processing(force)).withColumn(ROW, F.to_json(F.struct(*catalogue_key(rows))))
    done = rows.where(~needs_processing(force)).withColumn("status", F.lit("skip"))

    parsed = parse_repo_url(work)
    found = parsed.where(F.col("owner").isNotNull())
    # One row per project, read three times below.
    chosen = answers.keep(repos.choose_tree(found, trees, status))
    layouts = ("classification", "title")
    files = repos.key_files(chosen, trees, contents, per_file=repos.longest_cut(layouts))
    texts = repos.contexts(files.select(ROW, "rank", "path", "content"), layouts, [ROW]).withColumnRenamed(
        "classification_context", "context"
    )

    facts = chosen.select(ROW, "not_found")
    state = parsed.join(facts, ROW, "left").join(texts, ROW, "left")
    state = answers.keep(
        state.withColumns(
            {
                "not_found": F.coalesce("not_found", F.lit(False)),
                "has_files": F.col("context").isNotNull(),
            }
        )
    )

    asked = state.where(F.col("has_files") & needs_classification(force))
    if "course" not in asked.columns:
        asked = asked.withColumn("course", F.lit(None).cast("string"))
    asked = with_valid_types(asked, types or {})
    classified = ans.parse_answers(answers.of(ans.class_requests(asked))).select(
        ROW,
        F.col("deployment_type").alias("new_type"),
        F.col("deployment_reason").alias("new_reason"),
        F.col("cloud_provider").alias("new_cloud"),
    )
    state = state.join(classified, ROW, "left")

    type_now = F.when(needs_classification(force), F.col("new_type")).otherwise(
        F.col("deployment_type")
    )
    titling = state.where(F.col("has_files") & needs_title(force)).select(
        ROW, KEY, type_now.alias("deployment_type"), F.col("title_context").alias("context")
    )
    titled = propose_titles(titling, answers, by=ROW).select(
        ROW, "summary", F.col("best_title").alias("new_title")
    )
    state = state.join(titled, ROW, "left").withColumn("failure", F.lit(None).cast("string"))
    kept = [*rows.columns, "status"]
    finished = apply_states(state, force).select(*kept)
    return finished.unionByName(done.select(*kept))


def run(
    listed: DataFrame,
    old: DataFrame | None,
    trees: DataFrame,
    contents: DataFrame,
    status: DataFrame,
    answers: Answers,
    types: Mapping[str, Sequence[str]] | None = None,
    limit: int = 0,
) -> DataFrame:
    """A whole enrichment: results carried over, rows enriched, errors tried once more, texts tidied.

    `listed` is a cleaned list, `old` an earlier catalogue of it or None; where both have course and year, a URL
    carries its results within them alone. With a `limit` only the first rows of the list are worked on, and
    returned. `operators.enrich.run_metrics` sums up what comes back. Write the result before
    reading it again as the old one.
    """
    if old is None:
        rows = with_result_columns(listed)
    else:
        key = catalogue_key(listed) if set(catalogue_key(listed)) <= set(old.columns) else KEY
        rows = carry_enrichment(listed, old, key=key)
    rows = work_limit(rows, limit, catalogue_key(rows))
    first = answers.keep(enrich(rows, trees, contents, status, answers, types))
    again = lambda failed: enrich(failed, trees, contents, status, answers, types, force=True)
    return finish(retry(first, again))


def run_single(
    catalogue: DataFrame,
    url: str,
    trees: DataFrame,
    contents: DataFrame,
    status: DataFrame,
    answers: Answers,
    types: Mapping[str, Sequence[str]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """One project enriched anew, complete or not: the whole catalogue with its results, and what changed of it.

    Raises ValueError when the catalogue has no row of the URL. Trailing slashes are ignored.
    """
    rows = with_result_columns(catalogue)
    target = single_project(rows, url)
    if not target.head(1):
        raise ValueError(f"no row of project {url!r}")
    forced = lambda df: enrich(df, trees, contents, status, answers, types, force=True)
    done = answers.keep(retry(answers.keep(forced(target)), forced))
    key = catalogue_key(rows)
    merged = finish(merge_results(rows, done, key=key))
    return merged, changed_rows(target, single_project(merged, url), key=key)


def propose_titles(df: DataFrame, answers: Answers, need_summary: bool = True, by: str = KEY) -> DataFrame:
    """Summary, titles, best title for `(project_url, [subject], deployment_type, context)`, unique by the column `by`.

    Titles are asked for with a summary only, or with `need_summary` off in any case.
    """
    answered = answers.of(summary_requests(df))
    summarised = answered.select(*df.columns, summary_of(F.col("response")).alias("summary"))
    ready = F.col("summary") != "" if need_summary else F.lit(True)
    asked = title_requests(summarised.where(ready))
    scored = best_titles(score_titles(parse_titles(answers.of(asked))))
    scored = scored.drop("response", "error")
    second = answers.of(to_regenerate(scored)).select(by, "response")
    final = with_second_answers(scored, second, by)
    silent = summarised.where(~ready)
    return final.unionByName(silent, allowMissingColumns=True)


def finish(df: DataFrame) -> DataFrame:
    """The last touches before a catalogue is saved: encoding, then quotes and prefixes."""
    return clean_titles(repair_mojibake(df))


def enrich_from_readme(catalogue: DataFrame, readmes: DataFrame, answers: Answers) -> DataFrame:
    """Titles from READMEs `(project_url, content)` alone, for rows without a title.

    Existing titles stay; without a README, or without any proposal, the title
    is Unknown. All titles get the uniform wording. Requests and scores speak of
    owner/repo, or of the sanitised URL where it names a tree; a project whose
    summary came back empty is asked for titles all the same.
    """
    rows = with_result_columns(catalogue, RESULT_COLUMNS[:1])
    missing = rows.where(F.col("project_title").isNull() & F.col(KEY).isNotNull()).select(KEY)
    texts = readmes.where(F.length("content") > 0).select(
        KEY, cut(F.col("content"), 3500).alias("context")
    )
    subject = F.when(F.col(KEY).contains("/tree/"), sanitized(F.col(KEY))).otherwise(readme_slug(F.col(KEY)))
    asked = missing.join(texts, KEY).withColumns({"deployment_type": F.lit(None).cast("string"), "subject": subject})
    titled = propose_titles(asked, answers, need_summary=False).select(KEY, "best_title")
    joined = rows.join(titled, KEY, "left")
    title = F.coalesce("project_title", "best_title", F.lit("Unknown"))
    return normalise_titles(joined.withColumn("project_title", title)).drop("best_title")
