"""Keyword tables against a loop of patterns, one for each keyword."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest

from shelfmark.functions.keywords import CLOUD_KEYWORDS, DEPLOYMENT_KEYWORDS
from shelfmark.operators import keywords as kw
from shelfmark.operators import taxonomy as tx


def by_loop(text, rows):
    """{kind: (label, keyword, n)} by searching for every keyword."""
    found = defaultdict(lambda: defaultdict(list))
    rules = {}
    for kind, rule, label, label_order, keyword, keyword_order in rows:
        rules[kind] = rule
        if re.search(rf"\b{re.escape(keyword)}\b", text or "", re.I):
            found[kind][(label_order, label)].append((keyword_order, keyword))
    out = {}
    for kind, labels in found.items():
        rank = lambda o: (-len({k for _, k in labels[o]}) if rules[kind] == "most" else 0, o)
        best = min(labels, key=rank)
        out[kind] = (best[1], min(labels[best])[1], len({k for _, k in labels[best]}))
    return out


def test_ten_thousand_keywords(spark):
    draw = random.Random(4)
    word = lambda: "".join(draw.choices("abcdeéß字_9", k=draw.randint(1, 4)))
    keywords = sorted({draw.choice([word, lambda: f"{word()} {word()}", lambda: f"{word()}-{word()}", lambda: word().upper()])() for _ in range(14_000)})
    assert len(keywords) > 9_000
    rows = [(f"kind{i % 3}", ["first", "most"][i % 3 % 2], f"label{i % 40}", i % 40, k, i) for i, k in enumerate(keywords)]
    taxonomy = spark.createDataFrame(rows, "kind string, rule string, label string, label_order int, keyword string, keyword_order int")
    texts = [draw.choice([" ", ", ", "\n"]).join(draw.choice([word, lambda: draw.choice(keywords)])() for _ in range(draw.randint(0, 12))) for _ in range(40)]
    texts += ["", None, "x" * 10_000 + " " + keywords[5] + ". " + keywords[50].upper()]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, content string").repartition(3)
    got = defaultdict(dict)
    for r in tx.classify_by_table(df, taxonomy, "id").collect():
        got[r.id][r.kind] = (r.label, r.keyword, r.n)
    patterns = [(r, re.compile(rf"\b{re.escape(r[4])}\b", re.I)) for r in rows]
    for i, text in enumerate(texts):
        held = [r for r, p in patterns if p.search(text or "")]
        assert got[i] == by_loop(text, held), text


def test_the_given_lists_as_a_table(spark):
    taxonomy = tx.taxonomy_table(spark, {"deployment": ("first", DEPLOYMENT_KEYWORDS), "cloud": ("most", CLOUD_KEYWORDS)})
    texts = ["Batch jobs on AWS Glue, S3 and GCP", "a kafka stream with Flask", "éaws awsx", "Google Cloud Run, AWS", "Kafka ſtream", "nothing", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, content string")
    got = {(r.id, r.kind): (r.label, r.keyword) for r in tx.classify_by_table(df, taxonomy, "id").collect()}
    for r in kw.classify_text(df).collect():
        assert got.get((r.id, "deployment"), ("Unknown", "Unknown")) == (r.deployment_type, r.reason), r
        assert got.get((r.id, "cloud"), ("Unknown",))[0] == r.cloud, r


@pytest.mark.parametrize("block", [1, 7])
def test_tables_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(tx, "BLOCK", block)
    rows = [("k", "most", "a", 0, "one", 0), ("k", "most", "a", 0, "two", 1), ("k", "most", "b", 1, "One", 0), ("k", "most", "b", 1, "", 1), ("j", "first", "c", 0, "three", 0)]
    taxonomy = spark.createDataFrame(rows, "kind string, rule string, label string, label_order int, keyword string, keyword_order int")
    df = spark.createDataFrame([(1, "one three"), (2, "two one"), (3, "twoone")], "id int, content string")
    got = sorted(map(tuple, tx.classify_by_table(df, taxonomy, "id").collect()))
    assert got == [(1, "j", "c", "three", 1), (1, "k", "a", "one", 1), (2, "k", "a", "one", 2)]
    assert tx.classify_by_table(df, taxonomy.limit(0), "id").collect() == []
    assert tx.classify_by_table(df.limit(0), taxonomy, "id").collect() == []
