"""Bitmaps of keys: no key is left out, few others stay, and texts nobody asks for never move."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import repos as rp
from shelfmark.operators.keysets import key_bitmap, maybe_among, maybe_among_first
from tests.test_operators import landed, rows


@pytest.mark.parametrize("bits", [1, 8, 40_000, 1 << 20])
def test_no_key_is_left_out(spark, bits):
    keys = spark.range(0, 3000, 3).select(F.col("id").alias("a"), F.concat(F.lit("k"), "id").alias("b"))
    keys = keys.unionByName(spark.createDataFrame([(None, None), (5, None)], "a long, b string")).repartition(5)
    every = spark.range(20_000).select(F.col("id").alias("a"), F.concat(F.lit("k"), "id").alias("b"), F.lit(1).alias("_x"))
    every = every.unionByName(spark.createDataFrame([(None, None, 1), (5, None, 1)], "a long, b string, _x int"))
    bitmap = key_bitmap(keys, ["a", "b"], bits)
    assert bitmap.count() <= -(-bits // 32768)
    left = maybe_among(every, bitmap, ["a", "b"], bits)
    assert left.columns == every.columns
    match = left.join(keys, left["a"].eqNullSafe(keys["a"]) & left["b"].eqNullSafe(keys["b"]), "left_semi")
    assert match.count() == 1002
    assert left.count() <= {1: 20_002, 8: 20_002, 40_000: 2200, 1 << 20: 1100}[bits]


def test_no_keys(spark):
    every = spark.range(10)
    assert maybe_among(every, key_bitmap(every.limit(0), ["id"]), ["id"]).count() == 0


def test_texts_are_left_out_before_they_move(spark):
    trees, contents = landed(spark)
    projects = spark.createDataFrame([("o", "r", None, None)], "owner string, repo string, branch string, subpath string")
    files = rp.key_files(rp.choose_tree(projects, trees), trees, contents)
    plan = files._jdf.queryExecution().optimizedPlan().toString().split("\n")
    scans = [i for i, line in enumerate(plan) if "LogicalRDD" in line and "content#" in line]
    assert len(scans) == 1, "the contents are read once"
    above = [line for line in plan[: scans[0]]]
    bitmap = max(i for i, line in enumerate(above) if "_bucket" in line and "Join Inner" in line)
    window = max(i for i, line in enumerate(above) if "Window" in line and "row_number" in line and "landed_at" in line)
    assert bitmap > window, "the bitmap lies below the step that sorts texts"
    assert rows(files, "repo", "path", "content") == [("r", "Makefile", "new text"), ("r", "README.md", "plain")]


def test_texts_of_other_branches_are_left_out_before_they_move(spark, monkeypatch):
    trees, contents = landed(spark)
    more = contents.where("ref = 'main'").withColumn("ref", F.explode(F.array(F.lit("old"), F.lit("older"))))
    projects = spark.createDataFrame(
        [("o", "r", "main", None), ("o", "x", None, None)], "owner string, repo string, branch string, subpath string"
    )
    seen = []
    monkeypatch.setattr(rp, "one_per_key", lambda df, keys: seen.append(df) or df.dropDuplicates(keys))
    rp.key_files(rp.choose_tree(projects, trees), trees, contents.unionByName(more))
    assert rows(seen[-1].select("repo", "_ref").distinct()) == [("r", "main")]


def test_a_digest_moves_in_place_of_a_text(spark):
    trees, contents = landed(spark)
    projects = spark.createDataFrame([("o", "r", None, None)], "owner string, repo string, branch string, subpath string")
    files = rp.key_files(rp.choose_tree(projects, trees), trees, contents, text=F.md5("content"))
    whole = rp.key_files(rp.choose_tree(projects, trees), trees, contents)
    assert rows(files, "path", "content") == rows(whole.select("path", F.md5("content").alias("content")))
    plan = files._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("WindowGroupLimit [owner") < plan.index("md5(")


def test_no_row_is_asked_whether_its_hash_is_null(spark):
    keys = spark.range(3).select(F.col("id").alias("a"), F.concat(F.lit("k"), "id").alias("b"))
    left = maybe_among(keys, key_bitmap(keys, ["a", "b"]), ["a", "b"])
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(" not in plan.lower() and left.count() == 3


@pytest.mark.parametrize("lead", [None, 1])
@pytest.mark.parametrize("bits", [1, 8, 40_000, 1 << 20])
def test_a_filter_leaves_out_the_same_rows(spark, bits, lead):
    keys = spark.range(0, 3000, 3).select(F.col("id").alias("a"), F.concat(F.lit("k"), "id").alias("b"))
    keys = keys.unionByName(spark.createDataFrame([(None, None), (5, None)], "a long, b string")).repartition(5)
    every = spark.range(20_000).select(F.col("id").alias("a"), F.concat(F.lit("k"), "id").alias("b"))
    every = every.unionByName(spark.createDataFrame([(None, None), (5, None)], "a long, b string"))
    left = maybe_among_first(every, key_bitmap(keys, ["a", "b"], bits, lead), ["a", "b"], bits, lead)
    assert left.columns == every.columns and keys.exceptAll(left).count() == 0
    assert left.count() <= {1: 20_002, 8: 20_002, 40_000: 2200, 1 << 20: 1100}[bits]
    assert maybe_among_first(every, key_bitmap(keys.limit(0), ["a"], bits, lead), ["a"], bits, lead).count() == 0


@pytest.fixture
def small_bitmaps(monkeypatch):
    monkeypatch.setattr(rp, "BITS", 1 << 20)


def gathered_tables(spark):
    """Repositories with and without a branch, landings that repeat or tie, empty texts and keys that are null."""
    files = [("o", f"r{i}", b, p, "blob") for i in range(12) for b in ("main", "dev") for p in ("README.md", "a/Dockerfile", "a/main.tf")]
    trees = spark.createDataFrame(files, "owner string, repo string, branch string, path string, type string")
    held = [("o", f"r{i}", ref, p, f"{ref} {p} {i} {n % 2}" * (i % 4), n // 2) for i in range(12) for p in ("README.md", "a/Dockerfile", "a/main.tf", "x")
            for ref in (None, "", "main", "dev")[i % 3 :] for n in range(4)]
    held += [(None, "r1", "main", "README.md", "no", 1), ("o", None, None, "README.md", "no", 1), ("o", "r1", "main", None, "no", 1)]
    contents = spark.createDataFrame(held, "owner string, repo string, ref string, path string, content string, landed_at int")
    asked = [(n, "o", f"r{n % 13}", (None, "dev", "gone", "")[n % 4], ("", "a", None)[n % 3]) for n in range(40)] + [(99, None, "r1", None, None)]
    projects = spark.createDataFrame(asked, "id int, owner string, repo string, branch string, subpath string")
    return rp.choose_tree(projects, trees), trees, contents


@pytest.mark.parametrize("more", [{}, {"per_file": 9}, {"text": F.md5}])
def test_gathered_files_are_the_same_files(spark, small_bitmaps, more):
    more = {k: v("content") if callable(v) else v for k, v in more.items()}
    tables = gathered_tables(spark)
    spread, gathered = rp.key_files(*tables, **more), rp.key_files(*tables, **more, gathered=True)
    assert set(spread.columns) == set(gathered.columns)
    assert rows(spread, *sorted(spread.columns)) == rows(gathered, *sorted(spread.columns))
    assert {bool(r["ref"]) for r in gathered.collect()} == {True, False}
    once = [t.drop("landed_at") for t in tables]
    assert rows(rp.key_files(*once, **more), "id", "path", "content") == rows(rp.key_files(*once, **more, gathered=True), "id", "path", "content")


def test_gathered_texts_move_once(spark, small_bitmaps):
    projects, trees, contents = gathered_tables(spark)
    files = rp.key_files(projects, trees, contents, per_file=rp.longest_cut(["general"]), gathered=True)
    plan = rp.context(files)._jdf.queryExecution().executedPlan().toString().split("\n")
    scan = next(i for i, line in enumerate(plan) if "Scan ExistingRDD" in line and "content#" in line)
    above, at = [], plan[scan].index("Scan")
    for line in reversed(plan[:scan]):
        start = len(line) - len(line.lstrip(" :+-"))
        if start < at:
            above, at = [line, *above], start
    assert sum("Exchange" in line for line in above) == 1


def test_other_texts_are_left_out_below_what_contents_are_made_of(spark, small_bitmaps):
    projects, trees, contents = gathered_tables(spark)
    texts = contents.select(F.xxhash64("content").alias("text_id"), "content").distinct()
    named = contents.select("owner", "repo", "ref", "path", "landed_at", F.xxhash64("content").alias("text_id"))
    ref = F.when(F.col("ref") != "", F.col("ref")).alias("ref")
    made = named.unionByName(named).distinct().join(texts, "text_id").select("owner", "repo", ref, "path", "landed_at", "content")
    plan = rp.key_files(projects, trees, made, gathered=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("getbit(") > plan.index("Union") and plan.rindex("getbit(") > plan.index("text_id#")
    lines = plan.split("\n")
    filters = [i for i, line in enumerate(lines) if "Filter" in line and "getbit(" in line and "scalar-subquery" in line]
    assert filters and all(any("Aggregate" in line and "text_id" in line for line in lines[:i]) for i in filters)
