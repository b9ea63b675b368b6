"""Incremental batches: what a run has to work on, and what it may leave alone.

There is no event stream in this domain. New work is found by comparing landed
tables with the catalogue, at two grains: whole courses here, single rows in
`operators.enrich`.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from shelfmark.operators.courses import existing_courses, missing_courses, single_course

MODES = ("missing", "all", "single", "retry")


def worklist(
    courses: DataFrame,
    catalogue: DataFrame,
    mode: str = "missing",
    course: str | None = None,
    year: int | None = None,
    tracked: Mapping[str, str] | None = None,
    base: str = "",
) -> DataFrame:
    """Courses a run processes.

    missing: those the catalogue does not hold. all: every discovered one.
    single: one tracked course, discovered or not. retry: those with data, for
    another try at their unknown rows.
    """
    if mode == "missing":
        return missing_courses(courses, catalogue)
    if mode == "all":
        return courses
    if mode == "retry":
        return existing_courses(courses, catalogue)
    if mode == "single":
        if course is None or year is None or not tracked:
            raise ValueError("mode 'single' needs course, year and the tracked courses")
        return single_course(courses.sparkSession, course, year, tracked, base)
    raise ValueError(f"mode must be one of {MODES}")
