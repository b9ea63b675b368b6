"""Reading and writing lists, catalogues and landed tables."""

from __future__ import annotations

import base64
import json

import pytest

from shelfmark.sources import catalogue as cat
from shelfmark.sources import csv as sc
from shelfmark.sources import landed

from tests.test_operators import rows


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_scan_reads_text_quotes_and_missing_tokens(spark, tmp_path):
    path = write(tmp_path / "a.csv", '﻿project_url,score\nu1,"a ""b"", c"\nu2,NA\nu3,"two\nlines"\n,\n')
    df = sc.scan_csv(spark, path)
    assert df.columns == ["project_url", "score"]
    assert rows(df) == sorted([("u1", 'a "b", c'), ("u2", None), ("u3", "two\nlines"), (None, None)], key=repr)
    assert sc.scan_csv(spark, df) is df
    with pytest.raises(ValueError):
        sc.scan_csv(spark, 5)


def test_combine_by_name_over_differing_headers(spark, tmp_path):
    write(tmp_path / "1.csv", "project_url,col_a\nu1,x\n")
    write(tmp_path / "2.csv", "col_b,project_url\ny,u2\ny,u1\n")
    write(tmp_path / "3.csv", 'project_url,col_a\nu3,"x"\n')
    write(tmp_path / "notes.txt", "project_url\nno\n")
    both = sc.combine_files(spark, str(tmp_path))
    assert sorted(both.columns) == ["col_a", "col_b", "project_url"]
    assert rows(both, "project_url", "col_a", "col_b") == sorted(
        [("u1", "x", None), ("u1", None, "y"), ("u2", None, "y"), ("u3", "x", None)], key=repr
    )
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError):
        sc.combine_files(spark, str(tmp_path / "empty"))


def test_quoted_header_names_keep_their_columns(spark, tmp_path):
    write(tmp_path / "1.csv", '"note, extra",project_url,"a ""b"""\n"x, y",u1,z\n')
    write(tmp_path / "2.csv", "project_url,c\nu2,d\n")
    both = sc.combine_files(spark, str(tmp_path))
    assert rows(both, "project_url", "`note, extra`", '`a "b"`', "c") == [("u1", "x, y", "z", None), ("u2", None, None, "d")]
    found = {r["file"].rsplit("/", 1)[1]: r["ok"] for r in sc.validate_files(spark, str(tmp_path), ["note, extra"]).collect()}
    assert found == {"1.csv": True, "2.csv": False}


def test_legacy_list_with_empty_lines_before_its_header(spark, tmp_path):
    write(tmp_path / "old.csv", ",,\nproject_url,b,c\n,,\nu1,x,\n")
    (header,) = sc.headers(spark, str(tmp_path)).collect()
    assert header["header"] == ["project_url", "b", "c"] and header["late"]
    write(tmp_path / "new.csv", "project_url,b,c\nu2,y,z\n")
    combined = sc.combine_files(spark, str(tmp_path))
    assert rows(combined, "project_url", "b", "c") == [("u1", "x", None), ("u2", "y", "z")]


def test_cleaned_lists(spark, tmp_path):
    write(tmp_path / "cleaned_scraped_a_2023.csv", "project_url,x\nu1,1\nu1,2\n")
    write(tmp_path / "other.csv", "project_url\nu9\n")
    assert rows(sc.scan_cleaned(spark, str(tmp_path))) == [("u1",)]


def test_validation(spark, tmp_path):
    good = write(tmp_path / "good.csv", "a,project_url\n1,u\n")
    bad = write(tmp_path / "bad.csv", "a,b\n1,2\n")
    empty = write(tmp_path / "empty.csv", "")
    found = {r["file"].rsplit("/", 1)[1]: (r["ok"], r["missing"]) for r in sc.validate_files(spark, str(tmp_path)).collect()}
    assert found == {"good.csv": (True, []), "bad.csv": (False, ["project_url"])}
    assert sc.validate_changed(spark, [good, "README.md"])
    assert sc.validate_changed(spark, ["README.md", ""])
    assert not sc.validate_changed(spark, [good, bad])
    assert not sc.validate_changed(spark, [good, empty])
    assert not sc.validate_changed(spark, [str(tmp_path / "missing.csv")])


CAT = "project_url string, project_title string, deployment_type string, reason string, cloud string, course string, year string"


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_catalogue_partitions(spark, tmp_path, fmt):
    path = str(tmp_path / "cat")
    df = spark.createDataFrame(
        [("u1", "t, \"q\"", "Batch", "r", "GCP", "a", "2023"), ("u2", None, None, None, None, "a", "2024"), ("u3", "t", "B", "r", "c", "b", "2023")], CAT
    )
    cat.write(df, path, fmt)
    assert rows(cat.load(spark, path, fmt=fmt)) == rows(df)
    part = cat.load(spark, path, ["a"], [2023, 2030], fmt)
    assert rows(part, "project_url", "year") == [("u1", "2023")]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "course" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # writing one course and year again leaves the others alone
    cat.write(df.where("project_url = 'u1'").withColumn("project_title", df["reason"]), path, fmt)
    assert rows(cat.load(spark, path, fmt=fmt), "project_url", "project_title") == [("u1", "r"), ("u2", None), ("u3", "t")]
    assert [r["year"] for r in cat.years(cat.load(spark, path, fmt=fmt)).collect()] == ["2023", "2024"]


def test_years_skip_odd_folders_and_fall_back(spark):
    df = spark.createDataFrame([("a", "2022"), ("a", "notes"), ("b", "2021")], "course string, year string")
    assert [r["year"] for r in cat.years(df).collect()] == ["2021", "2022"]
    assert [r["year"] for r in cat.years(df.where("year = 'notes'")).collect()] == list(cat.DEFAULT_YEARS)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 2023, "u1", None), ("b", 2023, "u2", "3")], "course string, year int, project_url string, score string")
    sc.write_scraped(df, str(tmp_path / "scraped"))
    back = spark.read.option("header", True).csv(str(tmp_path / "scraped" / "course=b" / "year=2023"))
    assert rows(back) == [("u2", "3")]
    view = spark.createDataFrame([("t", ["a", "b"])], "project_title string, processed_titles array<string>")
    assert sc.export_filtered(view, str(tmp_path / "out"))
    assert rows(sc.scan_csv(spark, str(tmp_path / "out"))) == [("t", "a b")]
    assert not sc.export_filtered(view.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_export_names_and_paths(spark):
    df = spark.createDataFrame([("u", "t", "B", "r", "c", "a", "1")], CAT)
    assert cat.export_columns(df).columns == ["project_url", "project_title", "Deployment Type", "Reason", "Cloud"]
    made = cat.paths("Base/x", "c", 2024)
    assert made["data"] == "Base/x/c/2024/data.csv"
    assert made["cleaned"].endswith("cleaned_scraped_c_2024.csv") and made["titles"].endswith("projects_c_2024_cleaned_titles.csv")
    assert cat.paths_of("Base/x/c/2024/any.csv") == made
    with pytest.raises(ValueError):
        cat.paths_of("c/2024/any.csv")


def test_landed_tables(spark, tmp_path):
    tree = {"owner": "o", "repo": "r", "branch": "main", "tree": [{"path": "a", "type": "blob"}, {"path": "d", "type": "tree"}]}
    empty = {"owner": "o", "repo": "e", "branch": "main", "tree": []}
    trees = write(tmp_path / "trees.json", json.dumps(tree) + "\n" + json.dumps(empty))
    assert rows(landed.trees(spark, trees)) == sorted(
        [("o", "r", "main", "a", "blob"), ("o", "r", "main", "d", "tree"), ("o", "e", "main", None, None)], key=repr
    )
    encoded = base64.encodebytes(b"hello").decode()
    payload = lambda **kw: json.dumps({"owner": "o", "repo": "r", "ref": "main", "path": "a", "type": "file", "content": encoded, **kw})
    files = write(tmp_path / "files.json", "\n".join([payload(), payload(path="b", type="dir"), payload(path="c", content="")]))
    assert rows(landed.contents(spark, files)) == [("o", "r", "main", "a", "hello")]
