"""CSV files read in many splits, against one task that reads each file whole."""

from __future__ import annotations

import csv
import io
import random

import pytest

from shelfmark.sources import csv as sc
from shelfmark.sources import csv_splits as sp

TINY = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "64"}


@pytest.fixture
def tiny_splits(spark):
    before = {k: spark.conf.get(k, None) for k in TINY}
    for k, v in TINY.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def by_one_task(spark, path, names):
    options = {**sc.READ_OPTIONS, "header": True}
    return spark.read.options(**options).schema(sc.string_schema(names)).csv(path)


def text_of(rows, end, draw):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_MINIMAL)
    writer.writerow(["project_url", "note", "score"])
    for row in rows:
        if draw.random() < 0.1:
            out.write(end)
        writer.writerow(row)
    return out.getvalue()


def some_rows(draw, n):
    bits = ["a", "bc", ",", "\n", '"', '""', " ", "é", "字", "\n\n", ',"', '",', "word " * 5]
    value = lambda: "".join(draw.choices(bits, k=draw.randint(0, 8)))
    return [[f"u{i}", value(), draw.choice(["1", "", value()])] for i in range(n)] + [["long", "x,\n" * 200, "y"], ["z", "q" * 500, '"']]


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\r\n")])
def test_many_splits_as_one_task(spark, tmp_path, tiny_splits, seed, end):
    draw = random.Random(seed)
    folder = tmp_path / "lists"
    folder.mkdir()
    for k in range(3):
        text = text_of(some_rows(draw, 40), end, draw)
        (folder / f"{k}.csv").write_bytes((("﻿" if k else "") + text.rstrip(end if k == 2 else "")).encode())
    names = ["project_url", "note", "score"]
    got = sc.scan_csv(spark, str(folder))
    assert got.columns == names
    assert sp.lines(spark, str(folder)).select("file", "start").distinct().count() > 40
    want = sc.missing_to_null(by_one_task(spark, str(folder), names))
    tidy = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert tidy(got) == tidy(want)
    assert got.count() == 3 * 42
    assert tidy(sc.combine_files(spark, str(folder)).select(*names)) == tidy(want)


def test_states_of_splits_against_reading_on(spark, tmp_path, tiny_splits):
    draw = random.Random(9)
    text = text_of(some_rows(draw, 80), "\n", draw)
    (tmp_path / "a.csv").write_text(text, encoding="utf-8")
    rows = sp.lines(spark, str(tmp_path / "a.csv"))
    found = sorted(tuple(r) for r in sp.first_states(sp.split_maps(rows.where("NOT whole"))).select("start", "inside", "ends_inside").collect())
    inside, want = False, []
    by_split = {}
    for r in rows.collect():
        by_split.setdefault(r.start, []).append(r.value)
    for start in sorted(by_split):
        before = inside
        for line in by_split[start]:
            inside = sp.ends_inside(line, inside)
        want.append((start, before, inside))
    assert found == want
    assert {w[1:] for w in want} >= {(False, False), (True, False), (False, True)}


@pytest.mark.parametrize(
    "line, from_outside, from_inside",
    [
        ("a,b", False, True), ('"a,b', True, False), ('a"b', False, False), ('a,"b', True, False), ('"a""b"', False, False),
        ('"a"x,"', True, True), ('""', False, True), ('"""', True, False), ('",', True, False), ('","', False, True), ("", False, True),
    ],
)
def test_states_of_a_line(line, from_outside, from_inside):
    assert [sp.ends_inside(line, s) for s in (False, True)] == [from_outside, from_inside]


def test_a_header_over_several_splits(spark, tmp_path, tiny_splits):
    long = "note " * 60 + "\n" + "more " * 60
    (tmp_path / "a.csv").write_text(f'\n,,\n"{long}",project_url\n,\nx,u1\n,\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text('project_url,"c, d"\nu2,"one\ntwo"\n', encoding="utf-8")
    (tmp_path / "empty.csv").write_text("\n,,\n", encoding="utf-8")
    heads = {r["file"].rsplit("/", 1)[1]: (r["header"], r["late"]) for r in sc.headers(spark, str(tmp_path)).collect()}
    assert heads == {"a.csv": ([long, "project_url"], True), "b.csv": (["project_url", "c, d"], False)}
    both = sc.combine_files(spark, str(tmp_path))
    assert sorted(map(tuple, both.select(sc._quoted(long), "project_url", "`c, d`").collect()), key=repr) == sorted([(None, "u2", "one\ntwo"), ("x", "u1", None)], key=repr)


def test_quotes_left_open_end_with_the_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('project_url,note\nu1,"open\nu2,b\n', encoding="utf-8")
    (row,) = sc.scan_csv(spark, str(tmp_path / "a.csv")).collect()
    assert (row[0], row[1].rstrip("\n")) == ("u1", "open\nu2,b")


def test_turns_of_files(spark, tmp_path, tiny_splits, monkeypatch):
    monkeypatch.setattr(sp, "SPLITS", 40)
    draw = random.Random(5)
    for k in range(4):
        (tmp_path / f"{k}.csv").write_text(text_of(some_rows(draw, 20), "\n", draw), encoding="utf-8")
    assert sc.scan_csv(spark, str(tmp_path)).count() == 4 * 22


def test_no_turn_loses_a_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sp, "SPLITS", 2)
    for i in range(3):
        text = "project_url,note\n" + "".join(f'u{i}-{k},"a\nb{k}"\n' for k in range(300))
        (tmp_path / f"{i}.csv").write_text(text, encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        found = sp.records(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(found) == 3 * 301 and len({r["file"] for r in found}) == 3


def test_no_task_reads_a_large_file_alone(spark, tmp_path, tiny_splits):
    draw = random.Random(6)
    (tmp_path / "a.csv").write_text(text_of(some_rows(draw, 200), "\n", draw), encoding="utf-8")
    found = sp.records(spark, str(tmp_path / "a.csv"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert found.groupBy("start").count().count() > 50
