"""Both classifiers on documents they have not learned from, and on odd tables."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm.language_id import fit_temperature, language_ids, ngram_counts
from shelfmark.llm.quality_classifier import fit_rules, quality_scores, statistics

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_languages_held_out(documents):
    out = language_ids(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    tested = [r for r in out if r["held_out"] and r["lang"] and r["lang_pred"] != "und"]
    right = [r["lang_pred"] == r["lang"] for r in tested]
    assert len(out) == documents.count() and len(tested) > 200 and np.mean(right) > 0.97
    assert abs(np.mean([r["score"] for r in tested]) - np.mean(right)) < 0.05  # calibrated


def test_languages_odd_tables(spark):
    rows = [(1, None, "en", 0.5), (1, "123 !!", "en", 0.5), (None, "the cat", None, None), (5, "", "en", 0.1), (4, "x" * 90_000, "de", 0.2),
            (6, "é中", "fr", 0.3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = language_ids(docs).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert [r["lang_pred"] for r in got if r["score"] == 0].count("und") >= 3
    assert language_ids(docs.limit(0)).collect() == []
    unlearned = language_ids(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in unlearned} == {"und"}


def test_ngrams_and_temperature():
    at, n = ngram_counts("aXa")
    assert n.sum() == 3 + 2 + 1 and len(at) == len(n) and ngram_counts("")[0].size == 0
    rng = np.random.default_rng(0)
    logits = rng.normal(size=(4000, 3))
    p = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
    y = np.array([rng.choice(3, p=q) for q in p])
    assert fit_temperature(5 * logits, y) == pytest.approx(5, rel=0.1)


def test_quality_held_out(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = quality_scores(documents, labels)
    tested = out.where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in tested]) > 0.95
    assert out.count() == documents.count()


def test_quality_odd_tables(spark):
    rows = [(i, "good words here and there" if i % 2 else "## $$ ##", 1) for i in range(80)] + [(None, None, None), (3, "", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(None, 1), (3, None), (4, 9), (5, 0)], "doc_id long, quality int")
    got = quality_scores(docs, labels).collect()
    assert len(got) == 82 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert {r["score"] for r in quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_scores(docs.limit(0), labels).collect() == []


def test_rules_as_columns_equal_rules_as_loops(spark, documents):
    stats = statistics(documents).limit(300).cache()
    names = [c for c in stats.columns if c != "doc_id"]
    x = np.array([tuple(r) for r in stats.select(*names).collect()])
    model = fit_rules(x, (x[:, 0] > np.median(x[:, 0])).astype(float), names)
    assert 0 < len(model.rules)
    for row in stats.select("*", model.column().alias("score")).collect():
        total = model.bias + sum(w for rule, w in model.rules if all((row[n] <= c) == low for n, low, c in rule))
        assert row["score"] == pytest.approx(1 / (1 + np.exp(-total)))
