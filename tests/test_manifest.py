"""The keyed catalogue: merges touch their own partitions, and only a manifest makes them seen."""

from __future__ import annotations

import os

import pytest

from shelfmark.sources import manifest as mf
from tests.test_operators import rows

CAT = "project_url string, project_title string, deployment_type string, reason string, cloud string, course string, year string"


def table(spark, data):
    return spark.createDataFrame([(u, t, "Batch", "r", "AWS", c, y) for u, t, c, y in data], CAT)


def files(base):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(os.path.join(base, "data")) for f in names if f.endswith(".parquet")
    }


def listed(df):
    return rows(df, "project_url", "project_title", "course", "year")


def test_merges_by_course_year_and_url(spark, tmp_path):
    base = str(tmp_path / "cat")
    assert mf.load_current(spark, base).collect() == [] and mf.current(spark, base) == (0, {})
    first = [("u1", "a", "x", "2023"), ("u2", "b", "x", "2023"), ("u1", "again", "x", "2024"), ("u1", "c", "y", "2023"), (None, "n", "y", "2023")]
    assert mf.upsert(table(spark, first), base) == 1
    assert listed(mf.load_current(spark, base)) == sorted(first, key=repr)
    before = files(base)
    # one course and year again: a row changed, a row added, a null URL beside it
    assert mf.upsert(table(spark, [("u1", "A", "x", "2023"), ("u3", "d", "x", "2023"), (None, "m", "x", "2023")]), base) == 2
    want = [("u1", "A", "x", "2023"), ("u2", "b", "x", "2023"), ("u3", "d", "x", "2023"), (None, "m", "x", "2023"), *first[2:]]
    assert listed(mf.load_current(spark, base)) == sorted(want, key=repr)
    assert {f: t for f, t in files(base).items() if f in before} == before, "no old file is touched"
    new = {f for f in files(base) if f not in before}
    assert new and all("course=x/year=2023" in f for f in new), "only the touched partition is written"
    # the null key is a key too; equal keys in one merge count once
    mf.upsert(table(spark, [(None, "o", "y", "2023"), ("u9", "z", "y", "2023"), ("u9", "k", "y", "2023")]), base)
    assert listed(mf.load_current(spark, base, ["y"])) == sorted([("u1", "c", "y", "2023"), (None, "o", "y", "2023"), ("u9", "k", "y", "2023")], key=repr)
    assert mf.upsert(table(spark, []), base) == 3
    assert len(mf.unused_versions(spark, base, 1)) == 0 and mf.current(spark, base)[0] == 3
    mf.upsert(table(spark, [("u1", "B", "x", "2023")]), base)
    assert len(mf.unused_versions(spark, base, 1)) == 1


def test_other_partitions_are_not_read(spark, tmp_path):
    base = str(tmp_path / "cat")
    mf.upsert(table(spark, [("u1", "a", "x", "2023"), ("u2", "b", "y", "2024")]), base)
    mf.upsert(table(spark, [("u1", "b", "x", "2023")]), base)
    one = mf.load_current(spark, base, ["x"], [2023])
    assert len(one.inputFiles()) >= 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("DataFilters")[0]
    assert "version" in filters and "course" in filters
    assert rows(one, "project_title") == [("b",)]


def test_a_writer_lost_before_its_manifest(spark, tmp_path):
    base = str(tmp_path / "cat")
    mf.upsert(table(spark, [("u1", "a", "x", "2023")]), base)

    def dies():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        mf.upsert(table(spark, [("u1", "B", "x", "2023"), ("u2", "b", "x", "2023")]), base, before_commit=dies)
    assert listed(mf.load_current(spark, base)) == [("u1", "a", "x", "2023")]
    # half a manifest: a folder without its file
    os.makedirs(os.path.join(base, "manifests", "000000005", "_temporary"))
    assert mf.current(spark, base)[0] == 1
    assert mf.upsert(table(spark, [("u2", "b", "x", "2023")]), base) == 2
    assert listed(mf.load_current(spark, base)) == [("u1", "a", "x", "2023"), ("u2", "b", "x", "2023")]


def test_two_writers_at_a_time(spark, tmp_path):
    base = str(tmp_path / "cat")
    mf.upsert(table(spark, [("u1", "a", "x", "2023")]), base)
    other = lambda: mf.upsert(table(spark, [("u2", "first", "x", "2023")]), base)
    with pytest.raises(Exception, match="exist"):
        mf.upsert(table(spark, [("u2", "late", "x", "2023")]), base, before_commit=other)
    assert listed(mf.load_current(spark, base)) == [("u1", "a", "x", "2023"), ("u2", "first", "x", "2023")]


def test_odd_names(spark, tmp_path):
    base = str(tmp_path / "cat")
    data = [("u1", "a", "c/ d=%", "2023"), ("u2", "b", None, None)]
    mf.upsert(table(spark, data), base)
    mf.upsert(table(spark, [("u1", "A", "c/ d=%", "2023"), ("u3", "c", None, None)]), base)
    assert listed(mf.load_current(spark, base)) == sorted([("u1", "A", "c/ d=%", "2023"), ("u2", "b", None, None), ("u3", "c", None, None)], key=repr)
