"""Operators on small literal tables, one test per trap."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import clean as cl
from shelfmark.operators import courses as co
from shelfmark.operators import enrich as en
from shelfmark.operators import explore as ex
from shelfmark.operators import keywords as kw
from shelfmark.operators import pages as pg
from shelfmark.operators import repos as rp
from shelfmark.streaming.incremental import worklist


def rows(df, *cols):
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


# ---------------------------------------------------------------- clean


def test_clean_drops_empty_rows_before_it_projects(spark):
    df = spark.createDataFrame(
        [("u", "a"), ("u", "b"), (None, None), (None, "x"), (None, "y")], "project_url string, other string"
    )
    assert rows(cl.clean_and_deduplicate(df)) == [("u",), (None,)] or rows(
        cl.clean_and_deduplicate(df)
    ) == [(None,), ("u",)]
    assert rows(cl.clean_and_deduplicate(df, drop_null_key=True)) == [("u",)]


def test_clean_without_the_key_warns_and_keeps(spark):
    df = spark.createDataFrame([("a",), (None,)], "other string")
    with pytest.warns(UserWarning):
        assert rows(cl.clean_and_deduplicate(df)) == [("a",)]


def test_union_by_name_fills_and_is_idempotent(spark):
    a = spark.createDataFrame([("u1", "x")], "project_url string, col_a string")
    b = spark.createDataFrame([("y", "u2"), ("y", "u1")], "col_b string, project_url string")
    both = cl.union_by_name([a, b])
    assert both.columns == ["project_url", "col_a", "col_b"]
    once = cl.clean_and_deduplicate(both)
    again = cl.clean_and_deduplicate(cl.union_by_name([a, b, once]))
    assert rows(once) == rows(again) == [("u1",), ("u2",)]
    with pytest.raises(ValueError):
        cl.union_by_name([])


def test_update_titles_replaces_the_whole_column(spark):
    df = spark.createDataFrame([("u1", "old"), ("u2", "old"), (None, "old")], "project_url string, project_title string")
    titles = spark.createDataFrame([("u1", "new"), (None, "n")], "project_url string, project_title string")
    assert rows(cl.update_titles(df, titles)) == sorted([("u1", "new"), ("u2", None), (None, "n")], key=repr)


# ---------------------------------------------------------------- explore


@pytest.fixture(scope="module")
def catalogue(spark):
    data = [(i, ["a", "b", None][i % 3], float(i) if i % 5 else None, f"Title {i}", [str(i)]) for i in range(30)]
    data += [(30, "a", 3.0, "Unknown", ["x"]), (31, "b", 4.0, None, ["x"])]
    return spark.createDataFrame(
        data, "id int, kind string, score double, project_title string, tags array<string>"
    )


def test_hide_keeps_null_titles_and_both_switches_do_nothing(catalogue):
    assert ex.known_titles(catalogue).where("project_title IS NULL").count() == 1
    assert ex.known_titles(catalogue, True, True).count() == 32
    assert ex.known_titles(catalogue, False, False).count() == 32
    assert ex.known_titles(catalogue, False, True).count() == 1


def test_categories_keep_null_only_when_selected(catalogue):
    count = lambda values: ex.where(catalogue, kind=ex.OneOf(values)).count()
    assert count(["a", "b"]) == 22 and count(["a", "b", None]) == 32
    assert count([None]) == 10 and count([]) == 0


def test_chain_chooses_the_kind_and_open_ranges_drop_nulls(catalogue):
    # score has many values, hence a range; nulls leave even without an entry.
    assert ex.filter_chain(catalogue, hide=False).count() == 26
    # after a filter on id only few scores are left: a list, so nulls stay.
    few = ex.filter_chain(catalogue, {"id": (0, 6)}, hide=False)
    assert few.count() == 7
    by_pattern = ex.filter_chain(catalogue, {"project_title": "TITLE 1"}, hide=False)
    assert {r["id"] for r in by_pattern.collect()} == {i for i in [1, *range(10, 20)] if i % 5}
    with pytest.raises(ValueError):
        ex.filter_chain(catalogue, {"nope": 1})


def test_pattern_filter_case_and_null(spark):
    df = spark.createDataFrame([("École",), ("ecole",), (None,)], "t string")
    assert ex.where(df, t=ex.Matches("éCOLE")).count() == 1
    assert ex.where(df, t=ex.Matches("éCOLE", case_sensitive=True)).count() == 0


def test_counts_skip_nulls_and_order_ties(catalogue):
    assert [tuple(r) for r in ex.counts(catalogue, "kind").collect()] == [("a", 11), ("b", 11)]
    assert [tuple(r) for r in ex.counts(catalogue, "kind", 1).collect()] == [("a", 11)]


def test_pivot_has_all_given_columns_and_no_null_row(spark):
    df = spark.createDataFrame([("2023", "a"), ("2023", "a"), ("2024", "c"), (None, "a")], "year string, course string")
    pivot = ex.count_pivot(df, "year", "course", ["a", "b"])
    assert pivot.columns == ["year", "a", "b"]
    assert rows(pivot) == [("2023", 2, 0)]
    assert rows(ex.pivot_totals(pivot, "year"), "total") == [(2,)]
    empty = ex.count_pivot(df.limit(0), "year", "course", ["a"])
    assert empty.columns == ["year", "a"] and empty.count() == 0


def test_stacked_bars_start_where_the_one_before_ends(spark):
    df = spark.createDataFrame([("x", "big")] * 3 + [("x", "small"), ("y", "small"), ("y", "big")], "bar string, part string")
    assert rows(ex.stacked(df, "bar", "part"), "bar", "part", "base", "total") == [
        ("x", "big", 0, 4), ("x", "small", 3, 4), ("y", "big", 0, 2), ("y", "small", 1, 2),
    ]


def test_word_figures_with_and_without_lemmas(spark):
    df = spark.createDataFrame([(1, "The taxis of NYC"), (2, "Taxi data, taxis!"), (3, None), (4, "of")], "id int, project_title string")
    lemmas = spark.createDataFrame([("taxis", "taxi")], "form string, lemma string")
    plain = ex.preprocess(df)
    joined = ex.preprocess(df, lemmas=lemmas, key="id")
    assert rows(plain, "id", "processed_titles") == [
        (1, ["taxis", "nyc"]), (2, ["taxi", "data", "taxis"]), (3, None), (4, []),
    ]
    assert rows(joined, "id", "processed_titles") == [
        (1, ["taxi", "nyc"]), (2, ["taxi", "data", "taxi"]), (3, None), (4, []),
    ]
    want = [("taxi", 3), ("data", 1), ("nyc", 1)]
    assert [tuple(r) for r in ex.word_counts(plain, lemmas=lemmas).collect()] == want
    assert [tuple(r) for r in ex.word_counts(joined).collect()] == want
    assert [r["weight"] for r in ex.term_weights(joined, n=2).collect()] == [1.0, 1 / 3]


def test_shares_and_histogram(spark):
    df = spark.createDataFrame([(float(i),) for i in [0, 1, 2, 9, 10]] + [(None,), (float("nan"),)], "v double")
    bars = ex.histogram(df, "v", 5).orderBy("bin").collect()
    assert [b["n"] for b in bars] == [2, 1, 0, 0, 2]
    assert [b["low"] for b in bars] == [0.0, 2.0, 4.0, 6.0, 8.0]
    same = ex.histogram(df.where("v = 9"), "v", 3).orderBy("bin").collect()
    assert [b["n"] for b in same] == [1, 0, 0]
    text = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    assert [(r["c"], r["share"]) for r in ex.shares(text, "c").collect()] == [("a", 2 / 3), ("b", 1 / 3)]
    assert ex.histogram(text, "c").count() == 2


def test_correlations_use_complete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (4.0, 8.0)], "x double, y double")
    found = {(r["a"], r["b"]): r["r"] for r in ex.correlations(df).collect()}
    assert len(found) == 4 and found["x", "y"] == pytest.approx(1.0)


def test_profile_and_bounds(catalogue):
    found = {r["column"]: (r["n_distinct"], r["min"]) for r in ex.profile(catalogue, ["id", "kind"]).collect()}
    assert found == {"id": (32, "0"), "kind": (2, "a")}
    assert tuple(ex.range_bounds(catalogue, "id").first()) == (0.0, 31.0, 0.31)


# ---------------------------------------------------------------- pages


def page(url=None, score=None, more=True):
    body = f'<article><a href="{url}">x</a>{f"<span>{score}</span>" if score else ""}</article>' if url else ""
    return body + ('<a aria-label="Next page" href="?">n</a>' if more else "")


def test_paging_stops_and_first_seen_wins(spark):
    u = "https://github.com/u/"
    data = [
        (1, 1, page(u + "a", "5")), (1, 2, page(u + "b")), (1, 3, page(u + "a", "9", more=False)), (1, 4, page(u + "c")),
        (2, 1, page(u + "a")), (2, 2, page(None)), (2, 3, page(u + "d")),
        *[(3, n, page(u + f"x{n}")) for n in range(1, 104)],
    ]
    pages = spark.createDataFrame(data, "series_id int, page int, html string")
    reached = pg.stop_paging(pg.page_links(pages))
    assert rows(reached.where("series_id < 3"), "series_id", "page") == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2)]
    assert reached.where("series_id = 3").agg({"page": "max"}).first()[0] == 100
    assert rows(pg.scraped(pages).where("series_id < 3")) == [(1, u + "a", "5"), (1, u + "b", ""), (2, u + "a", "")]
    assert pg.scraped(pages).where("series_id = 3").count() == 100


def test_a_hole_ends_a_series(spark):
    u = "https://github.com/u/"
    data = [
        (1, 1, page(u + "a")), (1, 3, page(u + "c", more=False)),  # page 2 is not there
        (2, 2, page(u + "b", more=False)),  # nor the first one here
        (3, 1, page(None)), (3, 2, page(u + "z")),
        (4, 1, page(u + "a", more=False)), (4, 1, page(u + "a", more=False)),  # landed twice
        (5, 1, page(u + "a")), (5, 2, page(u + "b", more=False)),
        (6, 101, page(u + "a")), (7, None, page(u + "a")), (8, 1, None),
    ]
    pages = spark.createDataFrame(data, "series_id int, page int, html string").repartition(5)
    links = pg.page_links(pages)
    assert rows(pg.series_states(links)) == [
        (1, "incomplete", 1, 1, 1), (2, "missing", 0, 0, 1), (3, "empty", 1, 0, 1), (4, "complete", 1, 1, 0), (5, "complete", 2, 2, 0), (8, "empty", 1, 0, 0),
    ]
    assert rows(pg.scraped(pages), "series_id", "project_url") == [(1, u + "a"), (4, u + "a"), (5, u + "a"), (5, u + "b")]
    plan = pg.scraped(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert plan.count("regexp_extract_all") == 1, "the HTML is taken apart once"


# ---------------------------------------------------------------- courses

TRACKED = {"de-track": "data", "ml-track": "ml", "ml": "other"}


def test_discovery_status_and_worklists(spark):
    links = spark.createDataFrame(
        [(0, "/ml-track-2023/"), (1, "/de-track-2024"), (2, "/de-track-2025/"), (3, "/de-track-2024/"),
         (4, "/zz-2024"), (5, "/about"), (6, "/mlops-2022")],
        "link_id int, href string",
    )
    courses = co.discover(links, TRACKED, "https://c")
    assert [tuple(r)[:4] for r in courses.collect()] == [
        ("data", 2025, "de-track-2025", "https://c/de-track-2025/projects"),
        ("data", 2024, "de-track-2024", "https://c/de-track-2024/projects"),
        ("ml", 2023, "ml-track-2023", "https://c/ml-track-2023/projects"),
        ("other", 2022, "mlops-2022", "https://c/mlops-2022/projects"),
    ]
    catalogue = spark.createDataFrame([("data", "2024"), ("data", "2024"), ("ml", "x")], "course string, year string")
    names = lambda mode, **kw: rows(worklist(courses, catalogue, mode, **kw), "name", "year")
    assert names("missing") == [("data", 2025), ("ml", 2023), ("other", 2022)]
    assert names("retry") == [("data", 2024)]
    assert len(names("all")) == 4
    single = dict(course="ml", year=2030, tracked=TRACKED, base="https://c")
    assert rows(worklist(courses, catalogue, "single", **single), "slug") == [("ml-track-2030",)]
    with pytest.raises(ValueError):
        worklist(courses, catalogue, "single", course="nope", year=1, tracked=TRACKED)
    status = co.course_status(courses, catalogue)
    assert tuple(co.totals(status).first()) == (4, 1, 3)
    assert tuple(co.run_result(status, "has_data").first()) == (1, 4, False)
    urls = co.listing_urls(courses.where("name = 'ml'"), "https://c", 2)
    assert rows(urls, "page_url") == [
        ("https://c/ml-track-2023/projects",), ("https://c/ml-track-2023/projects?page=2",),
    ]


def test_valid_types_default(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "course string")
    typed = co.with_valid_types(df, {"a": ["Batch"]})
    assert rows(typed, "valid_types") == [(["Batch", "Streaming", "Web Service"],)] * 2 + [(["Batch"],)]


# ---------------------------------------------------------------- repositories


@pytest.mark.parametrize(
    "path, subpath, want",
    [
        ("en/Readme.md", None, True), ("docs/my_readme.md.bak", None, True), ("ops/docker-compose.yaml", None, True),
        ("infra/net.tf", None, True), ("etl/dags/x.py", None, True), ("src/kafka/a.py", None, True),
        ("kafka/flow.svg", None, False), ("readme.PNG", None, False), ("src/util.py", None, False),
        ("node_modules/kafka.js", None, True), ("x/node_modules/kafka.js", None, False),
        ("week3/README.md", "week3", True), ("Week3/README.md", "week3", True),
        ("week4/README.md", "week3", False), ("README.md", "week3", True), ("week33/README.md", "week3", False),
        ("a/README.md", "a/readme.md", True), ("a/README.md", "", True),
    ],
)
def test_should_fetch(spark, path, subpath, want):
    df = spark.createDataFrame([(path, subpath)], "p string, s string")
    assert df.select(rp.should_fetch(F.col("p"), F.col("s"))).first()[0] is want


def test_branch_preference_and_not_found(spark):
    projects = spark.createDataFrame(
        [("o", "r1", "dev"), ("o", "r1", None), ("o", "r2", "gone"), ("o", "r3", None), ("o", "r4", None), ("o", "r5", "x")],
        "owner string, repo string, branch string",
    )
    trees = spark.createDataFrame(
        [("o", "r1", "dev", "a", "blob"), ("o", "r1", "main", "a", "blob"), ("o", "r1", "main", "b", "tree"),
         ("o", "r2", "master", "a", "blob"), ("o", "r3", "trunk", "a", "blob")],
        "owner string, repo string, branch string, path string, type string",
    )
    status = spark.createDataFrame(
        [("o", "r3", 200, "trunk"), ("o", "r4", 404, None), ("o", "r5", 500, None), ("o", "r1", 404, None)],
        "owner string, repo string, status_code int, default_branch string",
    )
    chosen = rp.choose_tree(projects, trees, status)
    assert rows(chosen, "repo", "branch", "tree_branch", "not_found") == sorted(
        [("r1", "dev", "dev", False), ("r1", None, "main", False), ("r2", "gone", "master", False),
         ("r3", None, "trunk", False), ("r4", None, None, True), ("r5", "x", None, False)],
        key=repr,
    )


def brute_files(projects, files, k):
    """Every project with every file of its repository, the slow way."""
    from tests.brute import chosen_files

    return sorted(
        (p, path, rank)
        for p, repo, sub in projects
        for rank, path in enumerate(chosen_files([f for r, f in files if r == repo], sub, k), 1)
    )


def test_ranked_files_equal_brute_force_with_many_projects_in_one_repository(spark):
    rng = random.Random(3)
    folders = ["", "a", "a/b", "A", "c", "dags", "readme.md"]
    names = ["README.md", "Dockerfile", "main.tf", "x.png", "util.py", "requirements.txt", "readme.md"]
    files = sorted(
        {(r, "/".join(filter(None, [rng.choice(folders), rng.choice(["", "deep", "a"]), rng.choice(names)])))
         for r in ["one", "two"] for _ in range(60)}
    )
    subs = [None, "", "a", "a/b", "A/B", "c", "dags", "readme.md", "nowhere"]
    projects = [(i, "one" if i % 3 else "two", subs[i % len(subs)]) for i in range(40)]
    df = spark.createDataFrame([("o", r, "main", p, "blob") for r, p in files],
                               "owner string, repo string, branch string, path string, type string")
    pr = spark.createDataFrame([(i, "o", r, s, "main") for i, r, s in projects],
                               "id int, owner string, repo string, subpath string, tree_branch string")
    for k in (3, 10):
        got = sorted(tuple(r) for r in rp.ranked_files(pr, df, k).select("id", "path", "rank").collect())
        assert got == brute_files(projects, files, k)


def landed(spark):
    trees = spark.createDataFrame(
        [("o", "r", "main", "README.md", "blob"), ("o", "r", "main", "Makefile", "blob"), ("o", "x", "main", "README.md", "blob")],
        "owner string, repo string, branch string, path string, type string",
    )
    contents = spark.createDataFrame(
        [("o", "r", None, "README.md", "plain", 1), ("o", "r", "main", "README.md", "of main", 1), ("o", "r", "main", "Makefile", "old", 1),
         ("o", "r", "main", "Makefile", "new text", 2), ("o", "x", None, "README.md", "", 1)],
        "owner string, repo string, ref string, path string, content string, landed_at int",
    )
    return trees, contents


def test_texts_without_a_known_branch(spark):
    trees, contents = landed(spark)
    projects = spark.createDataFrame([("o", "r", None, None), ("o", "x", None, None)], "owner string, repo string, branch string, subpath string")
    files = rp.key_files(rp.choose_tree(projects, trees), trees, contents)
    # without a branch: what was landed without a ref, else the tree's branch; the latest landing once
    assert rows(files, "repo", "path", "content") == [("r", "Makefile", "new text"), ("r", "README.md", "plain")]
    named = rp.choose_tree(projects.withColumn("branch", F.lit("main")), trees)
    assert rows(rp.key_files(named, trees, contents, per_file=3), "repo", "path", "content") == [
        ("r", "Makefile", "new"), ("r", "README.md", "of "),
    ]


def test_repeated_status_rows_count_once(spark):
    trees, _ = landed(spark)
    projects = spark.createDataFrame([("o", "r", None), ("o", "gone", None)], "owner string, repo string, branch string")
    status = spark.createDataFrame(
        [("o", "r", 200, "dev", 1), ("o", "r", 200, "main", 2), ("o", "gone", 404, None, 2), ("o", "gone", 200, "main", 1)],
        "owner string, repo string, status_code int, default_branch string, landed_at int",
    )
    got = rp.choose_tree(projects, trees, status)
    assert rows(got, "repo", "default_branch", "not_found") == [("gone", None, True), ("r", "main", False)]


def test_trees_are_pruned_before_files_are_ranked_and_texts_cut_below_the_join(spark):
    trees, contents = landed(spark)
    projects = spark.createDataFrame([("o", "r", None, None)], "owner string, repo string, branch string, subpath string")
    chosen = rp.choose_tree(projects, trees)
    plan = rp.ranked_files(chosen, trees)._jdf.queryExecution().optimizedPlan().toString()
    explode = plan.index("Generate explode(", plan.index("LeftSemi"))
    assert "LeftSemi" in plan[explode:]  # deeper in the plan than the explode
    plan = rp.key_files(chosen, trees, contents, per_file=9)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("substring(") > plan.index("Join Inner")


def test_context_order_cuts_and_mark(spark):
    files = spark.createDataFrame(
        [("o", "r", 2, "b", "y" * 5000), ("o", "r", 1, "a", "x" * 5000)] + [("o", "s", i, f"f{i}", "z" * 5000) for i in range(1, 5)],
        "owner string, repo string, rank int, path string, content string",
    )
    text = {r["repo"]: r["context"] for r in rp.context(files).collect()}
    assert text["r"] == f"\n--- a ---\n{'x' * 4000}\n\n--- b ---\n{'y' * 4000}\n"
    assert len(text["s"]) == 15000 + len("\n[truncated...]") and text["s"].endswith("\n[truncated...]")
    titles = {r["repo"]: r["context"] for r in rp.context(files, "title").collect()}
    assert titles["s"].startswith("\n=== f1 ===\nz") and len(titles["s"]) == 6000


def test_best_readme(spark):
    files = spark.createDataFrame(
        [("o", "r", 1, "src/README.md", "deep"), ("o", "r", 2, "README", " top\nline "), ("o", "q", 1, "x.md", "no")],
        "owner string, repo string, rank int, path string, content string",
    )
    assert rows(rp.best_readme(files)) == [("o", "r", "README", "top line")]


def test_readme_of(spark):
    projects = spark.createDataFrame([("o", "r", ""), ("o", "r", "d")], "owner string, repo string, folder string")
    entries = spark.createDataFrame(
        [("o", "r", "", 1, "readme.MD", "file"), ("o", "r", "", 0, "README.md", "dir"), ("o", "r", "", 2, "README.md", "file")],
        "owner string, repo string, folder string, position int, name string, type string",
    )
    assert rows(rp.readme_of(projects, entries), "folder", "readme_name") == [("", "readme.MD"), ("d", None)]


# ---------------------------------------------------------------- keywords


def test_classify_by_keyword_states(spark):
    projects = spark.createDataFrame([("u1",), ("u2",), ("u3",), ("u4",), (None,)], "project_url string")
    readmes = spark.createDataFrame(
        [("u1", "Apache SPARK on GCP", None), ("u3", None, "request failed"), ("u4", None, "failed"), (None, "aws", None)],
        "project_url string, content string, status string",
    )
    assert rows(kw.classify_by_keyword(projects, readmes)) == sorted(
        [("u1", "Batch", "spark", "GCP"), ("u2",) + ("Unknown",) * 3, ("u3",) + ("Error",) * 3,
         ("u4", "Unknown", "Error", "Unknown"), (None,) + ("Unknown",) * 3],
        key=repr,
    )


def test_unknown_rate(spark):
    df = spark.createDataFrame([("u1", "Unknown"), ("u2", "AWS"), ("u3", None)], "project_url string, cloud string")
    assert tuple(kw.unknown_rate(df).first()) == (1, 3, pytest.approx(100 / 3))
    assert tuple(kw.unknown_rate(df.limit(0)).first()) == (0, 0, None)
    assert rows(kw.unknown_rows(df)) == [("u1",)]


# ---------------------------------------------------------------- enrich

CAT = "project_url string, project_title string, deployment_type string, reason string, cloud string"


def test_carry_takes_the_first_old_row_and_forgets_unlisted_ones(spark):
    cleaned = spark.createDataFrame([("u1",), ("u2",), (None,)], "project_url string")
    old = spark.createDataFrame(
        [("u1", "second", "B", "r", "c", 2), ("u1", "first", "B", "r", "c", 1), ("gone", "x", "B", "r", "c", 3), (None, "null", "B", "r", "c", 4)],
        CAT + ", at int",
    )
    carried = en.carry_enrichment(cleaned, old, order_by=["at"])
    assert carried.columns == ["project_url", *cl.RESULT_COLUMNS]
    assert rows(carried, "project_url", "project_title") == sorted([("u1", "first"), ("u2", None), (None, "null")], key=repr)
    partial = en.carry_enrichment(cleaned, old.select("project_url", "project_title"), order_by=["project_title"])
    assert rows(partial, "cloud") == [(None,)] * 3


@pytest.mark.parametrize(
    "title, kind, reason, force, want",
    [
        ("T", "Batch", "r", False, (False, False, False)),
        ("T", "Batch", "r", True, (True, True, True)),
        ("T", "Batch", "404: gone", True, (False, True, True)),
        ("T", " unknown ", "r", False, (True, True, False)),
        ("T", "Error", "r", False, (True, False, False)),
        ("Error", "Batch", "r", False, (True, False, True)),
        (None, None, None, False, (True, True, True)),
        ("T", "Batch", "x No Files Fetched y", False, (False, False, True)),
        ("T", None, None, False, (True, True, False)),
    ],
)
def test_needs(spark, title, kind, reason, force, want):
    df = spark.createDataFrame([("u", title, kind, reason, None)], CAT)
    r = en.with_needs(df, force).first()
    assert (r["needs_processing"], r["needs_classification"], r["needs_title"]) == want


FACTS = dict(not_found=False, has_files=True, new_type="Batch", new_reason="why", new_cloud="GCP",
             summary="s", new_title="New", failure=None)
FACT_TYPES = ("not_found boolean, has_files boolean, new_type string, new_reason string, new_cloud string, "
              "summary string, new_title string, failure string")


@pytest.mark.parametrize(
    "row, facts, force, want",
    [
        (("u", "T", "Batch", "r", "c"), {}, False, ("T", "Batch", "r", "c", "skip")),
        (("u", None, None, "404: x", None), {}, True, (None, None, "404: x", None, "skip")),
        (("u", None, None, None, None), {"not_found": True}, False, ("Unknown", "Unknown", en.NOT_FOUND_REASON, "Unknown", "skip")),
        (("u", None, None, None, None), {"has_files": False}, False, ("Unknown", "Unknown", en.NO_FILES_REASON, "Unknown", "skip")),
        (("u", None, None, None, None), {}, False, ("New", "Batch", "why", "GCP", "success")),
        (("u", "T", "Unknown", "r", "c"), {}, False, ("T", "Batch", "why", "GCP", "success")),
        (("u", "Unknown", "Batch", "r", "c"), {}, False, ("New", "Batch", "r", "c", "success")),
        # an Error type is worked on but not classified again unless forced
        (("u", "T", "Error", "r", "c"), {}, False, ("T", "Error", "r", "c", "success")),
        (("u", "T", "Error", "r", "c"), {}, True, ("New", "Batch", "why", "GCP", "success")),
        (("u", None, None, None, None), {"summary": ""}, False, ("Unknown", "Batch", "why" + en.NOTE_NO_SUMMARY, "GCP", "success")),
        (("u", None, "Batch", "r", "c"), {"new_title": None}, False, ("Unknown", "Batch", "r" + en.NOTE_NO_TITLES, "c", "success")),
        # nothing to append the note to
        (("u", None, "Batch", None, "c"), {"new_title": None}, False, ("Unknown", "Error", en.NO_REASON, "Error", "error")),
        (("u", "", None, "r", "c"), {"failure": "f" * 200}, False, ("Error", "Error", "f" * 100, "Error", "error")),
        ((None, "T", None, None, None), {}, False, ("T", "Error", en.NO_URL, "Error", "error")),
    ],
)
def test_result_states(spark, row, facts, force, want):
    df = spark.createDataFrame([(*row, *{**FACTS, **facts}.values())], f"{CAT}, {FACT_TYPES}")
    r = en.apply_states(df, force).first()
    assert (r["project_title"], r["deployment_type"], r["reason"], r["cloud"], r["status"]) == want


def test_retry_touches_only_errors_and_counts_add_up(spark):
    df = spark.createDataFrame(
        [("u1", "a", "b", "c", "d", "success"), ("u2", None, "Error", "x", "Error", "error"), (None, None, "Error", "y", "Error", "error"), ("u4", "a", "b", "c", "d", "skip")],
        CAT + ", status string",
    )
    seen = []

    def step(failed):
        seen.append(failed.count())
        fixed = failed.withColumn("status", F.when(F.col("project_url").isNull(), "error").otherwise("success"))
        return fixed.withColumn("project_title", F.lit("fixed"))

    done = en.retry(df, step)
    assert seen == [2]
    assert rows(done, "project_url", "project_title", "status") == sorted(
        [("u1", "a", "success"), ("u2", "fixed", "success"), (None, "fixed", "error"), ("u4", "a", "skip")], key=repr
    )
    assert tuple(en.status_counts(done).first()) == (2, 1, 1)
    assert en.run_metrics(done, 2).first()["rows_per_second"] == 2.0
    assert en.run_metrics(done, 0).first()["rows_per_second"] == 0.0


def test_merge_overwrites_with_nulls_and_keeps_the_rest(spark):
    df = spark.createDataFrame([("u1", "a", "b", "c", "d"), ("u2", "a", "b", "c", "d")], CAT)
    results = spark.createDataFrame([("u1", None, "n", "n", "n"), ("zz", "x", "x", "x", "x")], CAT)
    assert rows(en.merge_results(df, results)) == [("u1", None, "n", "n", "n"), ("u2", "a", "b", "c", "d")]


def test_run_outcomes_come_from_row_states(spark):
    courses = spark.createDataFrame([("a", 2024), ("b", 2024), ("c", 2024), ("d", 2024)], "name string, year int")
    states = spark.createDataFrame(
        [("a", "2024", "success"), ("a", "2024", "error"), ("b", "2024", "skip"), ("b", "2024", None), ("d", "2023", "skip"), ("c", "2024", "skip")],
        "course string, year string, status string",
    )
    outcomes = co.course_outcomes(courses, states)
    assert rows(outcomes, "name", "rows", "errors", "ok") == [("a", 2, 1, True), ("b", 2, 0, False), ("c", 1, 0, True), ("d", 0, 0, False)]
    assert tuple(co.run_result(outcomes).first()) == (2, 4, False)


def test_changed_rows_single_project_and_limit(spark):
    old = spark.createDataFrame([("u1/", "a", "b", "c", "d"), ("u2", None, "b", "c", "d")], CAT)
    new = old.withColumn("project_title", F.lit("a"))
    (diff,) = en.changed_rows(old, new).collect()
    assert (diff["project_url"], diff["changed"], diff["old_project_title"]) == ("u2", ["project_title"], None)
    assert rows(en.single_project(old, "u1"), "project_url") == [("u1/",)]
    assert en.work_limit(old, 1).collect()[0]["project_url"] == "u1/" and en.work_limit(old, 0).count() == 2


def test_retry_in_one_pass_and_without_failures(spark):
    rows_in = [("u1", None, None, None, None, "boom"), ("u2", "T", "Batch", "r", "GCP", None), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows_in, CAT + ", failure string").withColumns(
        {"not_found": F.lit(False), "has_files": F.lit(True), "new_type": F.lit("Batch"), "new_reason": F.lit("why"), "new_cloud": F.lit("AWS"),
         "summary": F.lit("s"), "new_title": F.lit("New")}
    )
    got = rows(en.retry_states(df), "project_url", "project_title", "reason", "status")
    assert got == sorted([("u1", "New", "why", "success"), ("u2", "T", "r", "skip"), (None, "Error", en.NO_URL, "error")], key=repr)
    first = en.apply_states(df)
    again = lambda failed: en.apply_states(failed.withColumn("failure", F.lit(None).cast("string")), force=True)
    names = ["project_url", "project_title", "reason", "status"]
    assert rows(en.retry(first, again), *names) == got

    def never(failed):
        raise AssertionError("nothing failed")

    assert rows(en.retry(first.where("status <> 'error'"), never), "project_url") == [("u2",)]


def test_results_of_null_and_repeated_keys_do_not_multiply_rows(spark):
    df = spark.createDataFrame([("u1", "a", "b", "c", "d"), (None, "x", "x", "x", "x"), (None, "y", "y", "y", "y")], CAT)
    results = spark.createDataFrame([("u1", "2", "n", "n", "n"), ("u1", "1", "n", "n", "n"), (None, "z", "z", "z", "z"), (None, "w", "w", "w", "w")], CAT)
    assert rows(en.merge_results(df, results), "project_url", "project_title") == sorted([("u1", "1"), (None, "w"), (None, "w")], key=repr)
    assert rows(cl.update_titles(df, results), "project_url", "project_title") == sorted([("u1", "1"), (None, "w"), (None, "w")], key=repr)
    found = en.changed_rows(results, df.where("project_title <> 'y'"))
    assert rows(found, "project_url", "old_project_title", "new_project_title") == sorted([("u1", "1", "a"), (None, "w", "x")], key=repr)


def test_kinds_of_columns_in_one_pass(spark):
    df = spark.range(5000).select(
        F.col("id"), (F.col("id") % 9).alias("few"), F.when(F.col("id") % 2 == 0, (F.col("id") % 20).cast("string")).alias("ten"),
        F.lit(None).cast("double").alias("none"), (F.col("id") % 9).cast("decimal(10,2)").alias("dec"), (F.col("id") % 11 > 3).alias("flag"),
    )
    assert ex.few_values(df, ["id", "few", "ten", "none", "dec", "flag"]) == {"id": False, "few": True, "ten": False, "none": True, "dec": True, "flag": True}
    found = {r["column"]: (r["n_distinct"], r["min"], r["max"]) for r in ex.profile(df, df.columns).collect()}
    assert found["id"] == (5000, "0", "4999") and found["ten"] == (10, "0", "8") and found["none"] == (0, None, None) and found["flag"] == (2, "false", "true")
    rough = {r["column"]: r["n_distinct"] for r in ex.profile(df, ["id", "few"], exact=False).collect()}
    assert rough["few"] == 9 and abs(rough["id"] - 5000) < 500
    plan = ex.profile(df, ["id", "few", "ten"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan


def test_tracked_prefixes_as_a_table(spark):
    names = {"a": "one", "ab-": "two", "b": "three", "bcd": "four", "zz": "five", **{f"p{i}": f"n{i}" for i in range(500)}}
    table = spark.createDataFrame([(p, n, i) for i, (p, n) in enumerate(names.items())], "prefix string, name string, position int")
    hrefs = ["/ab-x-2024", "/a-2024/", "/bcd-2021", "/zzz-2020", "/q-2020", "/p17-2022", "/p170-x-2022", "/about", None, "/ab-x-2024/"]
    links = spark.createDataFrame(list(enumerate(hrefs)), "link_id int, href string")
    as_table, as_settings = co.discover(links, table, "https://c"), co.discover(links, names, "https://c")
    assert [tuple(r) for r in as_table.collect()] == [tuple(r) for r in as_settings.collect()]
    assert as_table.count() == 5
    # the first in the given order counts, not the longest
    turned = table.withColumn("position", -F.col("position"))
    assert {r.slug: r.name for r in co.discover(links, turned, "https://c").collect()}["ab-x-2024"] == "two"
    assert co.discover(links, table.limit(0), "https://c").collect() == []


def test_a_path_is_looked_at_once(spark):
    paths = ["README.md", "a/readme", "dags/x.py", "dags/x.png", "x/node_modules/Dockerfile", "node_modules/Dockerfile", "a\n.tf", "b.csv\nkafka", "util.py", "setup.py/x", "kafka.lock", ""]
    df = spark.createDataFrame([(p,) for p in paths], "path string").where(rp.is_key_file(F.col("path")))
    assert sorted(r["path"] for r in df.collect()) == sorted(["README.md", "a/readme", "dags/x.py", "node_modules/Dockerfile", "a\n.tf", "b.csv\nkafka"])
    low, copied, binary = F.lower("path"), rp.COPIED, rp.BINARY
    three = low.rlike(rp.TELLING) & ~low.rlike(binary) & ~low.rlike(copied)
    some = spark.range(20_000).select(F.substring(F.translate(F.base64(F.sha2(F.col("id").cast("string"), 512).cast("binary")), "QXYZ", "/./t"), 1, 9).alias("path"))
    parts = F.array(*[F.lit(p) for p in (".tf", "dags/", "/venv/", "/.git/", ".png", ".log", "readme", "mage", "/", "x")])
    mixed = some.withColumn("path", F.concat(*[F.get(parts, F.pmod(F.xxhash64("path", F.lit(i)), F.lit(10)).cast("int")) for i in range(3)]))
    assert mixed.where(rp.is_key_file(F.col("path")) != three).count() == 0 and mixed.where(three).count() > 1000
    assert df._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 1
