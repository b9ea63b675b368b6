"""Quality rules and source mixing on small tables, against plain loops."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfmark.llm.mixing import mix_sources, source_targets
from shelfmark.llm.quality_rules import quality_rules, text_counts

TEXTS = [None, "", " \t\n", "one", "a b", "a b c", "a b c a b c", "x y z\nx y z\n\n \nx  y z", "w " * 60, "é ü ß # $\x0b%",
         "a a a a", "a b a b a b a", "q" * 500 + " " + "r s t " * 40, "<|x|> & *"]


def plain(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def documents(spark, sources=("a", "b", None)):
    rows = [(i, t, sources[i % len(sources)], 7, "x") for i, t in enumerate(TEXTS)]
    rows += [rows[5], (None, "n n n", None, 1, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_words long, kept string")


def test_counts(spark):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for row in text_counts(documents(spark).select("text", F.col("text").alias("t"))).collect():
        assert tuple(row[n] for n in names) == plain(row["t"]), row["t"]


def test_hosts_sway_their_documents(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good if i % 10 == 0 else "bad", "low") for i in range(40)] + [(100 + i, good, "high") for i in range(40)]
    rows += [(200, good, "new"), (201, good, None)]
    out = quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    kept = {r["doc_id"]: r["kept"] for r in out.collect()}
    assert not any(kept[i] for i in range(40))  # good ones among them too: the host decides
    assert all(kept[100 + i] for i in range(40)) and kept[200] and kept[201]
    rates = {r["doc_id"]: r["rate_short"] for r in out.collect()}
    assert 0 < rates[100] < rates[200] < rates[0]  # few documents: nearer to the mean of all hosts


def test_edges(spark):
    out = quality_rules(documents(spark)).collect()
    assert len(out) == len(TEXTS) + 2
    assert quality_rules(documents(spark).limit(0)).collect() == []
    assert mix_sources(documents(spark).limit(0)).collect() == []


def test_targets_fill_up(spark):
    sizes = spark.createDataFrame([("a", 1), ("b", 100), ("c", 100), (None, 5), ("d", 0)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in source_targets(sizes).collect()}
    # weights: a 3, b 1, c 2, d 3, null 1; a, d and null stop at twice their size; 297 are left for b and c, 2 parts of 3 for c
    assert got["a"] == 2 and got["d"] == 0 and got[None] == 10
    assert got["b"] == pytest.approx(297 / 3) and got["c"] == pytest.approx(198)


def test_mix(spark):
    rows = [(i, "w " * (1 + i % 7), "abc"[i % 3] if i % 11 else None) for i in range(600)]
    rows += [rows[3], (None, None, None), (9999, "", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("?"))
    out = mix_sources(docs)
    got = out.collect()
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, mix_sources(docs.repartition(3)).collect()))
    total = sum(r["size"] for r in got)
    for source in ("a", "b", "c", None):
        own = [r for r in got if r["source"] == source]
        assert {r["source_size"] for r in own} == {sum(r["size"] for r in own)}
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 4
        assert all(r["taken"] in (r["copies"] * r["size"],) and r["taken"] <= 2 * r["size"] for r in own)
        assert len({r["copies"] for r in own}) <= 2  # complete epochs, then a part
    assert sum(r["taken"] for r in got) == pytest.approx(1.5 * total, rel=0.01)


def test_quality_weights_draw_more(spark):
    rows = [(i, "w w w w" if i % 2 else "w w w $$$$", "s") for i in range(4000)]
    docs = spark.createDataFrame([*rows, (-1, "w " * 4000, "t")], "doc_id long, text string, source string")
    own = [r for r in mix_sources(docs, share=0.5).collect() if r["source"] == "s" and r["taken"]]
    assert sum(r["doc_id"] % 2 for r in own) > 0.8 * len(own) > 500


def test_mix_of_equal_keys_in_any_arrangement(spark):
    rows = [(None, "w " * (1 + i * 7 % 300) + f"x{i}", "a") for i in range(200)] + [(5, f"y{i} " * (1 + i % 9), "b") for i in range(100)]
    rows += [(7, "the same text", "b")] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = lambda df: sorted((str(r["doc_id"]), r["size"], r["taken"], r["copies"]) for r in mix_sources(df).collect())
    first = taken(docs)
    for turned in (docs.repartition(5), docs.orderBy("text"), docs.orderBy(F.desc("text")).coalesce(1)):
        assert taken(turned) == first
    assert len({t for _, _, t, _ in first}) > 2


def test_rows_without_words_are_not_repeated_more_than_others(spark):
    rows = [(i, "w " * 10, "a") for i in range(10)] + [(i, "", "a") for i in range(10, 20)] + [(i, "w " * 50, "b") for i in range(20, 60)] + [(99, None, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mix_sources(docs, share=3.0).collect()
    assert max(r["copies"] for r in out) == 2
    assert all(r["taken"] == 2 * r["size"] for r in out)
