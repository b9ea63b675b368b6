"""The exploration view: one filtered table and the figures shown for it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame

from shelfmark.operators import explore as ex
from shelfmark.sources.catalogue import select_partitions


def filtered_view(
    catalogue: DataFrame,
    courses: Sequence[str] | None = None,
    years: Sequence[str] | None = None,
    specs: Mapping[str, Any] | None = None,
    hide: bool = True,
    only: bool = False,
    legacy_nan: bool = True,
    lemmas: DataFrame | None = None,
    key: str | None = None,
) -> DataFrame:
    """Selected partitions, processed titles, filters. Cache it when several figures follow.

    With `lemmas` and a unique `key` the processed titles are lemmatised; `figures` then
    needs no lemmas of its own.
    """
    rows = ex.with_text_titles(select_partitions(catalogue, courses, years), legacy_nan)
    return ex.filter_chain(ex.preprocess(rows, lemmas=lemmas, key=key), specs, hide, only)


def figures(
    view: DataFrame, courses: Sequence[str], lemmas: DataFrame | None = None, top: int = 10
) -> dict[str, DataFrame]:
    """Every table behind the charts; each is lazy and small when it runs."""
    return {
        "top_titles": ex.counts(view, "project_title", top),
        "top_words": ex.word_counts(view, lemmas=lemmas, n=top),
        "term_weights": ex.term_weights(view, lemmas=lemmas),
        "courses": ex.shares(view, "course"),
        "deployment_types": ex.counts(view, "deployment_type"),
        "clouds": ex.counts(view, "cloud"),
        "years_by_course": ex.count_pivot(view, "year", "course", courses),
        "clouds_by_course": ex.count_pivot(view, "cloud", "course", courses),
        "deployments_by_course": ex.count_pivot(view, "deployment_type", "course", courses),
        "years_stacked": ex.stacked(view, "year", "course", courses),
        "clouds_stacked": ex.stacked(view, "cloud", "course", courses),
        "deployments_stacked": ex.stacked(view, "deployment_type", "course", courses),
    }
