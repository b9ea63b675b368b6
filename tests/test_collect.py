"""Whole runs: listing pages to catalogue, URL to label."""

from __future__ import annotations

import base64

import pytest

from shelfmark.plans import collect, enrichment
from shelfmark.sources import manifest
from tests.test_operators import page, rows
from tests.test_plans import Model, landed

U = "https://github.com/o/"


@pytest.fixture
def answers(tmp_path):
    (tmp_path / "asked").mkdir()
    return enrichment.Answers(Model(tmp_path / "asked"), str(tmp_path / "answers"), 2, str(tmp_path / "scratch"))


def test_runs_over_courses(spark, tmp_path, answers):
    courses = spark.createDataFrame([("x", 2023, "x-2023"), ("x", 2024, "x-2024"), ("y", 2024, "y-2024")], "name string, year int, slug string")
    pages = spark.createDataFrame(
        [("x-2023", 1, page(U + "good")), ("x-2023", 2, page(U + "poor", more=False)), ("x-2023", 3, page(U + "never")),
         ("x-2024", 1, page(U + "good", more=False)), ("y-2024", 1, page(None)), ("z-2024", 1, page(U + "gone"))],
        "slug string, page int, html string",
    )
    base = str(tmp_path / "catalogue")
    tables = landed(spark)
    first = collect.update_catalogue(courses, pages, *tables, answers, base)
    assert first.manifest == 1
    listed = lambda: rows(manifest.load_current(spark, base), "course", "year", "project_url", "project_title")
    want = [("x", "2023", U + "good", "Taxi Trips Dashboard View"), ("x", "2023", U + "poor", "Better taxi trips dashboard"), ("x", "2024", U + "good", "Taxi Trips Dashboard View")]
    assert listed() == sorted(want, key=repr)
    assert rows(first.listings, "slug", "status") == [("x-2023", "complete"), ("x-2024", "complete"), ("y-2024", "empty")]
    assert rows(first.outcomes, "name", "year", "rows", "ok") == [("x", 2023, 2, True), ("x", 2024, 1, True), ("y", 2024, 0, False)]
    assert first.metrics.first()["total"] == 3
    # again: the courses with data are not missing any more, and nothing is asked
    asked = len(list((tmp_path / "asked").iterdir()))
    second = collect.update_catalogue(courses, pages, *tables, answers, base)
    assert second.manifest == 1 and second.outcomes.count() == 1
    assert len(list((tmp_path / "asked").iterdir())) == asked
    # one course of one year, with a new page; the others keep their rows
    more = pages.unionByName(spark.createDataFrame([("x-2024", 1, page(U + "good")), ("x-2024", 2, page(U + "gone", more=False))], pages.schema))
    more = more.where("slug <> 'x-2024' OR page > 1 OR html LIKE '%Next page%'")
    fourth = collect.update_catalogue(courses.where("slug = 'x-2024'"), more, *tables, answers, base, "all")
    assert fourth.manifest == 2
    assert listed() == sorted([*want, ("x", "2024", U + "gone", "Unknown")], key=repr)
    # another try at what is in the catalogue
    fifth = collect.update_catalogue(courses, more, *tables, answers, base, "retry")
    assert fifth.outcomes.count() == 2 and len(listed()) == 4


def test_classification_from_readmes(spark):
    coded = lambda s: base64.b64encode(s).decode()
    projects = spark.createDataFrame(
        [(U + "a", 1), (U + "b/tree/main/sub", 2), (U + "c/tree/main/main/sub", 3), (U + "d", 4), ("https://gitlab.com/o/e", 5), (None, 6), (U + "f/blob/main/README.md", 7), (U + "g", 8)],
        "project_url string, n int",
    )
    entries = spark.createDataFrame(
        [("o", "a", "", 0, "ReadMe.md", "file"), ("o", "b", "sub", 0, "README.md", "file"), ("o", "b", "", 0, "README.md", "file"),
         ("o", "c", "main/sub", 0, "README.md", "file"), ("o", "d", "", 0, "notes.md", "file"), ("o", "g", "", 1, "README.md", "file")],
        "owner string, repo string, folder string, position int, name string, type string",
    )
    files = spark.createDataFrame(
        [("o", "a", "ReadMe.md", coded(b"A Kafka stream on AWS")), ("o", "b", "sub/README.md", coded(b"spark batch, GCP")), ("o", "b", "README.md", coded(b"flask")),
         ("o", "c", "sub/README.md", coded(b"a flask app on Azure")), ("o", "f", "README.md", coded(b"hadoop")), ("o", "g", "README.md", coded(b"\xff\xfe"))],
        "owner string, repo string, path string, content_b64 string",
    )
    got = {r["n"]: (r["deployment_type"], r["cloud"]) for r in collect.classify_from_readmes(projects, entries, files).collect()}
    assert got == {
        1: ("Streaming", "AWS"), 2: ("Batch", "GCP"), 3: ("Web Service", "Azure"), 4: ("Unknown", "Unknown"), 5: ("Unknown", "Unknown"),
        6: ("Unknown", "Unknown"), 7: ("Batch", "Unknown"), 8: ("Unknown", "Unknown"),
    }
