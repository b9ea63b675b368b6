"""Whole jobs with a stand-in model, and the plans they rely on."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import answers as an
from shelfmark.operators import clean as cl
from shelfmark.operators import enrich as en
from shelfmark.operators import explore as ex
from shelfmark.operators import pages as pg
from shelfmark.operators import repos as rp
from shelfmark.plans import dashboard, enrichment
from tests.test_operators import CAT, rows


class Model:
    """Answers by rule and writes every prompt it is asked into a folder."""

    def __init__(self, folder):
        self.folder = str(folder)

    def __call__(self, prompts):
        import os
        import uuid

        out = []
        for p in prompts:
            with open(os.path.join(self.folder, uuid.uuid4().hex), "w") as f:
                f.write(p)
            if p.startswith("Classify"):
                if "boom" in p:
                    raise RuntimeError("model down")
                kind = "Streaming" if "kafka" in p else "Batch"
                out.append(f"DEPLOYMENT: {kind}\nDEPLOYMENT_REASON: seen\nCLOUD: AWS")
            elif p.startswith("Describe"):
                out.append(None if "silent" in p else "taxi trips dashboard")
            elif "BATCH" in p or "STREAMING" in p:
                out.append("1. Taxi Trips Dashboard View\n2. X" if "good" in p else "1. X\n2. Y")
            else:
                out.append("1. Better taxi trips dashboard")
        return out


@pytest.fixture
def answers(tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()
    return enrichment.Answers(Model(asked), str(tmp_path / "answers"), 2, str(tmp_path / "scratch"))


def asked(tmp_path):
    return len(list((tmp_path / "asked").iterdir()))


def landed(spark):
    trees, contents = [], []
    for repo, text in [("good", "airflow"), ("poor", "kafka"), ("silent", "silent"), ("boom", "boom")]:
        trees += [("o", repo, "main", "README.md", "blob"), ("o", repo, "main", "img.png", "blob")]
        contents += [("o", repo, "main", "README.md", text), ("o", repo, "main", "img.png", "no")]
    trees.append(("o", "bare", "main", "img.png", "blob"))
    status = [("o", r, 404 if r == "gone" else 200, "main") for r in ["good", "poor", "silent", "boom", "gone", "bare"]]
    return (
        spark.createDataFrame(trees, "owner string, repo string, branch string, path string, type string"),
        spark.createDataFrame(contents, "owner string, repo string, ref string, path string, content string"),
        spark.createDataFrame(status, "owner string, repo string, status_code int, default_branch string"),
    )


def test_enrichment_from_repositories(spark, tmp_path, answers):
    u = "https://github.com/o/"
    listed = [(u + r,) for r in ["good", "poor", "silent", "boom", "gone", "bare"]] + [("nonsense",), (None,)]
    old = spark.createDataFrame([(u + "kept", "T", "Batch", "r", "GCP")], CAT)
    catalogue = cl.with_result_columns(spark.createDataFrame(listed, "project_url string")).unionByName(old)
    done = enrichment.enrich(catalogue, *landed(spark), answers)
    found = {r["project_url"]: tuple(r)[1:] for r in done.select("project_url", *cl.RESULT_COLUMNS, "status").collect()}
    assert len(found) == 9
    assert found[u + "kept"] == ("T", "Batch", "r", "GCP", "skip")
    assert found[u + "good"] == ("Taxi Trips Dashboard View", "Batch", "seen", "AWS", "success")
    assert found[u + "poor"] == ("Better taxi trips dashboard", "Streaming", "seen", "AWS", "success")
    assert found[u + "silent"] == ("Unknown", "Batch", "seen" + en.NOTE_NO_SUMMARY, "AWS", "success")
    assert found[u + "boom"][1:] == ("Unknown", "model down", "Unknown", "success")
    assert found[u + "gone"] == ("Unknown", "Unknown", en.NOT_FOUND_REASON, "Unknown", "skip")
    assert found[u + "bare"] == found["nonsense"] == ("Unknown", "Unknown", en.NO_FILES_REASON, "Unknown", "skip")
    assert found[None] == ("Error", "Error", en.NO_URL, "Error", "error")
    assert sum(en.status_counts(done).first()) == 9

    # a second run asks nothing again but the prompt that failed
    before = asked(tmp_path)
    again = enrichment.enrich(catalogue, *landed(spark), answers)
    assert rows(again) == rows(done)
    assert 0 < asked(tmp_path) - before <= 4

    # what is enriched is left alone; only unfinished rows are worked on
    third = enrichment.enrich(done.drop("status"), *landed(spark), answers)
    kept = {r["project_url"]: r["status"] for r in third.collect()}
    assert kept[u + "good"] == kept[u + "gone"] == "skip"
    finished = enrichment.finish(done.withColumn("project_title", F.lit('Title: "SÃ£o"')))
    assert {r["project_title"] for r in finished.collect()} == {"São"}


def test_whole_run_retries_errors_once(spark, answers):
    u = "https://github.com/o/"
    listed = spark.createDataFrame([(u + "good",), (u + "silent",), (None,)], "project_url string")
    # a title is wanted, the model is silent, and there is no reason to note it in
    old = spark.createDataFrame([(u + "silent", None, "Batch", None, "GCP"), (u + "unlisted", "T", "B", "r", "c")], CAT)
    done = enrichment.run(listed, old, *landed(spark), answers)
    found = {r["project_url"]: (r["project_title"], r["reason"], r["status"]) for r in done.collect()}
    assert found == {
        u + "good": ("Taxi Trips Dashboard View", "seen", "success"),
        u + "silent": ("Unknown", "seen" + en.NOTE_NO_SUMMARY, "success"),
        None: ("Error", en.NO_URL, "error"),
    }


def test_single_project_is_forced_and_must_exist(spark, answers):
    u = "https://github.com/o/"
    old = spark.createDataFrame([(u + "good/", "T", "Batch", "r", "GCP"), (u + "poor", "P", "Batch", "r", "GCP")], CAT)
    merged, changed = enrichment.run_single(old, u + "good", *landed(spark), answers)
    assert rows(merged, *cl.RESULT_COLUMNS) == [("P", "Batch", "r", "GCP"), ("Taxi Trips Dashboard View", "Batch", "seen", "AWS")]
    (diff,) = changed.collect()
    assert (diff["project_url"], diff["old_project_title"], diff["changed"]) == (u + "good/", "T", ["project_title", "reason", "cloud"])
    with pytest.raises(ValueError):
        enrichment.run_single(old, u + "absent", *landed(spark), answers)


def test_enrichment_from_readmes(spark, answers):
    catalogue = spark.createDataFrame(
        [("u/good", None), ("u/none", None), ("u/has", "Fraud Detection"), ("u/silent", None), (None, None)],
        "project_url string, project_title string",
    )
    readmes = spark.createDataFrame(
        [("u/good", "taxi"), ("u/has", "taxi"), ("u/silent", "silent"), ("u/none", "")], "project_url string, content string"
    )
    titles = dict(rows(enrichment.enrich_from_readme(catalogue, readmes, answers), "project_url", "project_title"))
    assert titles == {
        "u/good": "Better taxi trips dashboard", "u/none": "Unknown", "u/has": "Fraud Prediction",
        "u/silent": "Better taxi trips dashboard", None: "Unknown",  # asked for titles though its summary is empty
    }


def test_hook_asks_each_prompt_once_and_isolates_failures(spark, tmp_path):
    requests = spark.createDataFrame([("a",)] * 5 + [("bad",), ("b",)], "prompt string")

    def model(prompts):
        if "bad" in prompts:
            raise ValueError("no " + "x" * 200)
        return [p.upper() for p in prompts]

    got = {r["prompt"]: (r["response"], r["error"]) for r in an.stored_answers(requests, model, str(tmp_path / "t"), 1).collect()}
    assert got["a"] == ("A", None) and got["b"] == ("B", None)
    assert got["bad"][0] is None and len(got["bad"][1]) == 100
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3


def test_dashboard(spark):
    data = [("u1", "Taxi data", "Batch", "r", "GCP", "a", "2023"), ("u2", None, "Batch", "r", None, "b", "2023"), ("u3", "Unknown", None, "r", "AWS", "a", "2024")]
    catalogue = spark.createDataFrame(data, CAT + ", course string, year string")
    view = dashboard.filtered_view(catalogue).cache()
    assert view.count() == 2
    figures = {k: v.collect() for k, v in dashboard.figures(view, ["a", "b"]).items()}
    assert [tuple(r) for r in figures["top_titles"]] == [("Taxi data", 1), ("nan", 1)]
    assert [r["word"] for r in figures["top_words"]] == ["data", "nan", "taxi"]
    assert [tuple(r) for r in figures["years_by_course"]] == [("2023", 1, 1)]
    assert [tuple(r) for r in figures["clouds"]] == [("GCP", 1)]
    assert dashboard.filtered_view(catalogue, ["a"], ["2024"], hide=False).count() == 1


# ---------------------------------------------------------------- plans


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_row_choices_are_cut_before_the_shuffle(spark):
    links = spark.createDataFrame([(1, 1, 0, "u", "")], "series_id int, page int, pos int, project_url string, score string")
    old = spark.createDataFrame([("u", "a", "b", "c", "d")], CAT)
    for df in (pg.first_seen(links), en.first_per_key(old, ["reason"])):
        below = plan_of(df).split("Exchange hashpartitioning")[1]
        assert "WindowGroupLimit" in below


def test_file_choice_never_pairs_projects_with_trees(spark):
    trees = spark.createDataFrame([("o", "r", "main", "README.md", "blob")], "owner string, repo string, branch string, path string, type string")
    projects = spark.createDataFrame([("o", "r", "main", None)], "owner string, repo string, tree_branch string, subpath string")
    plan = plan_of(rp.ranked_files(projects, trees))
    assert plan.count("WindowGroupLimit") >= 2
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_counts_combine_before_their_shuffle(spark):
    df = spark.createDataFrame([("a", "b")], "row string, col string")
    for counted in (ex.counts(df, "row"), ex.count_pivot(df, "row", "col", ["b"]), ex.pair_counts(df, "row", "col")):
        assert "partial_count" in plan_of(counted)
    assert "TakeOrderedAndProject" in plan_of(ex.counts(df, "row", 10))


def test_a_url_in_two_years_is_two_rows(spark, answers):
    u = "https://github.com/o/"
    cat = "course string, year string, " + CAT
    rows_in = [("x", "2023", u + "good", None, None, None, None), ("x", "2024", u + "good", "Kept", "Batch", "r", "GCP"),
               ("y", "2023", u + "good", None, None, None, None), ("x", "2024", u + "poor", None, None, None, None)]
    catalogue = spark.createDataFrame(rows_in, cat)
    done = enrichment.enrich(catalogue, *landed(spark), answers)
    got = rows(done, "course", "year", "project_url", "project_title", "status")
    assert got == sorted([
        ("x", "2023", u + "good", "Taxi Trips Dashboard View", "success"), ("x", "2024", u + "good", "Kept", "skip"),
        ("y", "2023", u + "good", "Taxi Trips Dashboard View", "success"), ("x", "2024", u + "poor", "Better taxi trips dashboard", "success"),
    ], key=repr)
    # results are carried within their course and year
    listed = catalogue.select("course", "year", "project_url")
    old = spark.createDataFrame([("x", "2023", u + "good", "Old", "Batch", "r", "GCP"), ("x", "2022", u + "poor", "No", "Batch", "r", "GCP")], cat)
    run = enrichment.run(listed, old, *landed(spark), answers)
    titles = {(r["course"], r["year"], r["project_url"]): r["project_title"] for r in run.collect()}
    assert len(titles) == 4 and titles["x", "2023", u + "good"] == "Old" and titles["x", "2024", u + "poor"] != "No"
    assert enrichment.run(listed, old, *landed(spark), answers, limit=1).count() == 1
