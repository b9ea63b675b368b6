"""Column functions on literal cases."""

from __future__ import annotations

import base64
import random
import re

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import answers as fa
from shelfmark.functions import html as fh
from shelfmark.functions import keywords as fk
from shelfmark.functions import text as ft
from shelfmark.functions import titles as fti
from shelfmark.functions import urls as fu
from shelfmark.operators import answers as an
from shelfmark.operators import urls as ur


def apply(spark, values, fn):
    """fn over one text column, results in the order of the values."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in df.select("i", fn(F.col("v"))).orderBy("i").collect()]


# ---------------------------------------------------------------- text


def test_strip_removes_all_white_space(spark):
    values = ["  a b \t\n", " x ", "\x1cy\x1f", "　", "", None]
    assert apply(spark, values, ft.strip) == [v.strip() if v is not None else None for v in values]


def test_words_split_as_python_does(spark):
    values = ["a  b\tc", " lead", "no break", "", "  "]
    assert apply(spark, values, ft.words) == [v.split() for v in values]


def test_na_tokens(spark):
    values = ["NA", "null", "nan", "", "None", "none", "x", None]
    assert apply(spark, values, ft.na_to_null) == [None] * 5 + ["none", "x", None]


@pytest.mark.parametrize(
    "broken, repaired",
    [
        ("LÃ¸ten og ZÃ¼rich", "Løten og Zürich"),
        ("naÃ¯ve reader", "naïve reader"),
        ("v2: faÃ§ade", "v2: façade"),
        ("Genève", "Genève"),
        ("10â€¯km", "10â€¯km"),
        ("Ã", "Ã"),
        ("to Â be", "to Â be"),
        ("ZÃ¼rich 大阪", "ZÃ¼rich 大阪"),
        ("Å\x82", "Å\x82"),
        ("", ""),
        (None, None),
    ],
)
def test_mojibake(spark, broken, repaired):
    assert apply(spark, [broken], ft.mojibake_repaired) == [repaired]


def test_content_words_drop_punctuation_before_stop_words(spark):
    values = ["The NYC-Taxi Data, don't!", "of the", "it’s a test"]
    want = [["nyctaxi", "data", "dont"], [], ["it’s", "test"]]
    assert apply(spark, values, ft.content_words) == want


def test_cut_counts_characters_and_marks(spark):
    assert apply(spark, ["éé東京x"], lambda c: ft.cut(c, 4)) == ["éé東京"]
    assert apply(spark, ["abcdef", "abc"], lambda c: ft.cut(c, 3, "...")) == ["abc...", "abc"]


def test_known(spark):
    values = ["Unknown", " ERROR ", "", "x", None]
    assert apply(spark, values, ft.known) == [False, False, True, True, False]


# ---------------------------------------------------------------- URLs


def parsed(spark, url):
    df = spark.createDataFrame([(url,)], "project_url string")
    r = ur.parse_repo_url(df).first()
    return r["owner"], r["repo"], r["subpath"], r["branch"]


@pytest.mark.parametrize(
    "url, want",
    [
        ("https://github.com/ada/engine", ("ada", "engine", None, None)),
        ("https://github.com/ada/engine/", ("ada", "engine", None, None)),
        ("https://github.com/ada/engine.git", ("ada", "engine", None, None)),
        ("https://github.com/ada/engine/tree/main", ("ada", "engine", None, "main")),
        ("https://github.com/u/r/tree/main/lib/part", ("u", "r", "lib/part", "main")),
        ("https://github.com/u/r?tab=readme-ov-file", ("u", "r", None, None)),
        ("https://github.com/u/r#", ("u", "r", None, None)),
        ("https://github.com/u/r/blob/main/lib/x.rs", ("u", "r", None, "main")),
        ("https://github.com/u/r/tree/main/p?tab=x#readme", ("u", "r", "p", "main")),
        ("https://github.com/u/r/tree/main/Proj%202/x", ("u", "r", "Proj 2/x", "main")),
        ("https://github.com/u/r/tree/feature%2Fxyz/src", ("u", "r", "src", "feature/xyz")),
        ("https://github.com/u/r/tree/a+b%zz/100%", ("u", "r", "100%", "a+b%zz")),
        (" https://github.com/u/r \n", ("u", "r", None, None)),
        ("a/b", ("a", "b", None, None)),
        ("just words", (None,) * 4),
        ("http://github.com/u/r", (None,) * 4),
        (None, (None,) * 4),
    ],
)
def test_parse_repo_url(spark, url, want):
    assert parsed(spark, url) == want


@pytest.mark.parametrize(
    "url, want",
    [
        ("https://github.com/ada/engine", True),
        ("HTTPS://github.com/ada/engine", True),
        ("https://github.com/a b", True),
        ("http://github.com/ada/engine", False),
        ("https://codeberg.org/ada/engine", False),
        ("https://github.com.example.org/u/r", False),
        ("https://example.org/github.com/u/r", False),
        ("https://github.com/", False),
        ("https://github.com", False),
        ("https://github.com/?x", False),
        ("just words", False),
        ("", False),
        (None, False),
    ],
)
def test_is_project_url(spark, url, want):
    assert apply(spark, [url], fu.is_project_url) == [want]


def test_sanitized(spark):
    values = ["https://h/p?q#f", "HTTP://H/p;x", "https://h/a;b/c", "a/b", "https://h#f"]
    want = ["https://h/p", "http://H/p", "https://h/a;b/c", "://a/b", "https://h"]
    assert apply(spark, values, fu.sanitized) == want


@pytest.mark.parametrize(
    "url, want",
    [
        ("https://github.com/u/r", ("u", "r", None, "", False)),
        ("https://GitHub.com/u/r/", ("u", "r", None, "", False)),
        ("https://github.com/u/r.git/a/b", ("u", "r", None, "a/b", False)),
        ("https://github.com/u/r/tree/dev/a/b", ("u", "r", "dev", "a/b", False)),
        ("https://github.com/u/r/blob/dev/a.py", ("u", "r", "dev", "a.py", False)),
        ("https://github.com/u/r/blob/main/README.md", ("u", "r", None, None, True)),
        ("https://github.com/u/r/tree", (None,) * 5),
        ("https://github.com/u", (None,) * 5),
        ("https://gitlab.com/u/r", (None,) * 5),
        (None, (None,) * 5),
    ],
)
def test_locate_readmes(spark, url, want):
    df = spark.createDataFrame([(url,)], "project_url string")
    r = ur.locate_readmes(df).first()
    assert (r["owner"], r["repo"], r["branch"], r["folder"], r["direct"]) == want


def test_readme_candidates_drop_the_branch_once(spark):
    rows = [("https://github.com/u/r/tree/dev/dev/x", "ReadMe.md"), ("https://github.com/u/r", None)]
    df = spark.createDataFrame(rows, "project_url string, readme_name string")
    got = [(r["path"], r["fallback_path"]) for r in ur.readme_candidates(ur.locate_readmes(df)).collect()]
    assert got == [("dev/x/ReadMe.md", "x/ReadMe.md"), (None, None)]


def test_course_slug(spark):
    values = ["/de-track-2024", "/de-track-2024/", "/De-2024", "/x-24", "https://h/ab-2023/", None]
    got = [tuple(v) if v else None for v in apply(spark, values, fu.course_slug)]
    want = [("de-track-2024", 2024)] * 2 + [None, None, ("ab-2023", 2023), None]
    assert got == want


# ---------------------------------------------------------------- HTML


def test_page_projects_prefer_articles(spark):
    page = """
    <ARTICLE class="x"><a name="y">no</a><a class='l' href='https://github.com/u/r?a=1&amp;b=2'>t</a>
      <span> <b>32</b> </span><span>9</span></ARTICLE>
    <article><a href="https://example.com/o">o</a><a href="https://github.com/u/second">s</a></article>
    <article><a href="https://github.com/u/noscore">n</a></article>
    <table><tr><td><a href="https://github.com/u/cell">c</a></td></tr></table>"""
    (got,) = apply(spark, [page], fh.page_projects)
    assert [tuple(p) for p in got] == [
        ("https://github.com/u/r?a=1&b=2", "32"),
        ("https://github.com/u/noscore", ""),
    ]


def test_page_projects_fall_back_to_cells(spark):
    page = """<article><a href="http://github.com/u/insecure">x</a></article>
    <table><thead><tr><th><a href="https://github.com/u/head">h</a></th></tr></thead>
    <tr><td>no link</td><td><a href="https://github.com/u/one">1</a><a href="https://github.com/u/two">2</a></td></tr></table>"""
    (got,) = apply(spark, [page], fh.page_projects)
    assert [tuple(p) for p in got] == [("https://github.com/u/head", ""), ("https://github.com/u/one", "")]
    assert apply(spark, ["<p>none</p>"], fh.page_projects) == [[]]


def test_next_page_and_archive(spark):
    nav = '<nav><a aria-label="Next page" href="?page=2">n</a></nav>'
    assert apply(spark, [nav, "<a href='?page=2'>Next page</a>", None], fh.has_next_page) == [True, False, False]
    home = (
        '<section><h2>Active</h2><a href="/a-2026/">a</a></section>'
        '<section><h2>Course <i>archive</i></h2><a href="/b-2024/">b</a></section>'
    )
    assert apply(spark, [home, '<a href="/c-2020">c</a>'], fh.archive_hrefs) == [["/b-2024/"], ["/c-2020"]]


# ---------------------------------------------------------------- keywords


def test_keyword_hits_equal_one_search_per_keyword(spark):
    keywords = fk.all_keywords(fk.DEPLOYMENT_KEYWORDS, fk.CLOUD_KEYWORDS)
    rng = random.Random(7)
    glue = [" ", ".", ", ", "\n", "_", "x", "é", "-", ""]
    texts = []
    for _ in range(200):
        parts = [rng.choice(keywords) for _ in range(rng.randint(0, 6))]
        cased = [rng.choice([str.lower, str.upper, str.title])(p) for p in parts]
        texts.append("".join(rng.choice(glue) + p + rng.choice(glue) for p in cased))
    texts += ["", "éaws", "aws_x", "azure sql database", "AWS Glueless", "ſpark", None]
    got = apply(spark, texts, lambda c: fk.keyword_hits(c, keywords))
    for text, hits in zip(texts, got):
        if text is None:
            assert hits is None
            continue
        want = {k.lower() for k in keywords if re.search(rf"\b{re.escape(k)}\b", text, re.I)}
        assert set(hits) == want, text


def test_deployment_is_a_waterfall_with_the_first_listed_keyword(spark):
    texts = ["kafka and flask", "spark after hadoop", "streaming", "nothing", "stream"]
    keywords = fk.all_keywords(fk.DEPLOYMENT_KEYWORDS)
    got = apply(spark, texts, lambda c: fk.deployment_of(fk.keyword_hits(c, keywords)))
    assert [tuple(g) for g in got] == [
        ("Web Service", "flask"), ("Batch", "hadoop"), ("Streaming", "streaming"),
        ("Unknown", "Unknown"), ("Streaming", "stream"),
    ]


def test_cloud_counts_distinct_keywords_and_breaks_ties_by_order(spark):
    texts = ["aws aws aws gcp bigquery", "azure then aws", "heroku", "none"]
    keywords = fk.all_keywords(fk.CLOUD_KEYWORDS)
    got = apply(spark, texts, lambda c: fk.cloud_of(fk.keyword_hits(c, keywords)))
    assert got == ["GCP", "AWS", "Heroku", "Unknown"]


# ---------------------------------------------------------------- titles


def test_title_list(spark):
    answer = "1. NYC Taxi\n2.  Fare\n\n- Dashed title\n  3. Taxi  \n1. NYC Taxi\n4.\n12-.x\n5 plain"
    want = ["NYC Taxi", "Fare", "- Dashed title", "Taxi", "x", "5 plain"]
    assert apply(spark, [answer, None, ""], fti.title_list) == [want, [], []]


def score(spark, title, url="url", summary="summary"):
    df = spark.createDataFrame([(title, url, summary)], "t string, u string, s string")
    context = fti.context_words(F.col("u"), F.col("s"))
    return df.select(fti.title_score(F.col("t"), context)).first()[0]


@pytest.mark.parametrize(
    "title, url, summary, want",
    [
        # 4 words +2; 'tide' and 'level' of the context +2
        ("Harbour Tide Level Forecast", "tide-watch", "tide level readings", 4),
        # one word -1; fewer than 2 specific words -2
        ("Forecast", "u", "s", -3),
        # 3 words +2; 'smart' and 'hub' -2
        ("Smart Tide Hub", "u", "s", 0),
        # generic first word -1, 'system' -1, one specific word -2, length +2
        ("Cloud storage reports system", "u", "s", -2),
        # a repeated word counts each time: 'taxi' twice +2, length +2, colon +1
        ("Taxi: taxi taxi go", "u", "taxi", 5),
        # too long -1, hyphen +1
        ("one two three four five six-seven eight", "u", "s", 0),
    ],
)
def test_title_score(spark, title, url, summary, want):
    assert score(spark, title, url, summary) == want


def test_best_title_prefers_the_earlier_of_equals(spark):
    df = spark.sql("SELECT array('x', 'y', 'A good taxi title', 'A good taxi theme') AS t, array('taxi') AS c")
    best = df.select(fti.best_title(fti.scored_titles(F.col("t"), F.col("c")))).first()[0]
    assert (best["title"], best["score"]) == ("A good taxi title", 3)
    text = df.select(fti.feedback(fti.best_title(fti.scored_titles(F.col("t"), F.col("c"))))).first()[0]
    assert text == "The best title is 'A good taxi title' with a score of 3."
    none = spark.sql("SELECT CAST(array() AS array<string>) AS t, array('taxi') AS c")
    assert none.select(fti.best_title(fti.scored_titles(F.col("t"), F.col("c")))).first()[0] is None


def test_wording(spark):
    values = ['Title: "Churn Classifier"', "Fraud Detection Predictor", None]
    assert apply(spark, values, fti.without_marks) == ["Churn Classifier", "Fraud Detection Predictor", None]
    want = ["Churn Classification", "Fraud Prediction Prediction", None]
    assert apply(spark, values, fti.uniform_wording) == want


# ---------------------------------------------------------------- answers


def classified(spark, response, **extra):
    names = ["response", *extra]
    df = spark.createDataFrame([(response, *extra.values())], ", ".join(f"{n} string" for n in names))
    r = an.parse_answers(df).first()
    return tuple(r[f] for f in fa.ANSWER_FIELDS)


@pytest.mark.parametrize(
    "response, want",
    [
        ("DEPLOYMENT: Batch\nDEPLOYMENT_REASON: Uses DAGs\nCLOUD: GCP\nCLOUD_REASON: x",
         ("Batch", "Uses DAGs", "GCP", "x")),
        ("DEPLOYMENT: streaming, BATCH\n  CLOUD: Google Cloud", ("Batch, Streaming", "Unknown", "GCP", "Unknown")),
        ("DEPLOYMENT: Streamlit", ("Streaming", "Unknown", "Unknown", "Unknown")),
        ("DEPLOYMENT: Web API\nCLOUD: Amazon Web Services", ("Web Service", "Unknown", "AWS", "Unknown")),
        ("DEPLOYMENT: Batch\nDEPLOYMENT: n/a\nCLOUD: Hetzner \nCLOUD_REASON:", ("Unknown", "Unknown", "Hetzner", "")),
        ("text DEPLOYMENT: Batch\nCLOUD: not known, unknown", ("Unknown", "Unknown", "Unknown", "Unknown")),
        ("CLOUD: azure\r\nCLOUD: aws on azure\r\n", ("Unknown", "Unknown", "AWS", "Unknown")),
        (None, ("Unknown", "LLM returned no response") * 2),
        ("", ("Unknown", "LLM returned no response") * 2),
    ],
)
def test_parse_answers(spark, response, want):
    assert classified(spark, response) == want


def test_failed_answers_carry_the_error(spark):
    assert classified(spark, None, error="e" * 200) == ("Unknown", "e" * 100) * 2


def test_outside_types(spark):
    df = spark.sql("SELECT array('Batch', 'Streaming') AS valid_types, t AS deployment_type FROM VALUES ('Batch'), ('Unknown'), ('Batch, Web Service') v(t)")
    got = {r["deployment_type"]: r["outside_valid_types"] for r in an.flag_outside_types(df).collect()}
    assert got == {"Batch": False, "Unknown": False, "Batch, Web Service": True}


def test_prompts_carry_hint_and_types(spark):
    df = spark.sql("SELECT 'u' AS project_url, 'files' AS context, array('Batch', 'Other') AS valid_types, 'Batch, Streaming' AS deployment_type, 's' AS summary")
    prompt = an.class_requests(df).first()["prompt"]
    assert "one of Batch, Other, Unknown" in prompt and fa.TYPE_HELP["Batch"] in prompt
    hint = lambda t: spark.sql(f"SELECT {t} AS t").select(fa.title_hint(F.col("t"))).first()[0]
    assert hint("'Batch, Streaming'") == fa.STREAM_HINT
    assert hint("'Web Service'") == fa.BATCH_HINT
    assert hint("''") == hint("CAST(NULL AS STRING)") == ""


def test_payloads(spark):
    encode = lambda b: base64.encodebytes(b).decode()
    values = [encode("ã".encode() * 10), encode(b"\xff\xfeab"), "aGVs*bG8=", "", None, encode(b"x" * 9000)]
    lenient = apply(spark, values, fa.decoded_payload)
    assert lenient == ["ã" * 10, "��ab", "hello", None, None, "x" * 8000]
    strict = apply(spark, values, fa.strictly_decoded)
    assert strict == ["ã" * 10, None, "hello", "", None, "x" * 9000]
    assert apply(spark, [encode(b"x")], lambda c: fa.decoded_payload(c, F.lit("dir"))) == [None]
