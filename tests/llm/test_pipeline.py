"""The pipeline's stages on the smallest documents, each against its own input."""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfmark.llm.common import stored
from tests.llm.test_jaccard_join import plain_components, plain_sets
from tests.llm.test_suffix_dedup import plain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    tables = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(stored(stage(spark, tables[-1], SF)))
    return tables


def test_columns_stay(kept):
    assert [t.columns for t in kept[:-1]] == [kept[0].columns] * 5 and len(corpus_pipeline.STAGES) == 5
    assert [t.dtypes for t in kept[:-1]] == [kept[0].dtypes] * 5


def test_quality_keeps_clean_documents(spark, kept):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = {r["doc_id"] for r in kept[1].collect()}
    wrong = [d for d, q in labels.items() if (d in left) != bool(q)]
    assert len(wrong) <= 0.06 * len(labels)  # of a table with 58 labels to learn from


def test_one_of_each_class_stays(kept):
    rows = [(r["doc_id"], r["text"]) for r in kept[1].collect()]
    sets = plain_sets(rows, 5)
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = {d for d, c in plain_components(list(sets), links).items() if d == c}
    assert {r["doc_id"] for r in kept[2].collect()} == want and len(want) < len(rows)


def test_repeated_passages_go(kept):
    removed = {d: n for d, _, n, *_ in plain([(r["doc_id"], (r["text"] or "").encode()) for r in kept[2].collect()], 50)}
    before = {r["doc_id"]: len((r["text"] or "").encode()) for r in kept[2].collect()}
    after = {r["doc_id"]: len((r["text"] or "").encode()) for r in kept[3].collect()}
    assert all(0 <= n - (before[d] - removed[d]) <= 40 for d, n in after.items())
    assert all(removed[d] >= before[d] - 40 for d in set(before) - set(after)) and sum(removed.values()) > 0


def test_mix_and_packing(kept):
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken = Counter(), Counter()
    for r in kept[3].collect():
        sizes[r["source"]] += count(r["text"])
    for r in kept[4].collect():
        taken[r["source"]] += count(r["text"])
    assert set(taken) <= set(sizes) and all(taken[s] <= 2 * sizes[s] for s in sizes)
    assert sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.05)
    pieces = kept[5].collect()
    assert Counter(r["doc_id"] for r in pieces if r["piece"] == 0) == Counter(r["doc_id"] for r in kept[4].collect())
    room = Counter()
    for r in pieces:
        room[r["sequence_id"]] += r["length"]
    assert max(room.values()) <= 1024 and len(room) <= 1.05 * sum(room.values()) / 1024 + 2


def test_quality_with_null_and_repeated_ids(spark, kept):
    labelled = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [r for r in kept[1].collect() if r["doc_id"] not in labelled][0]
    left = {r["doc_id"] for r in kept[1].collect()}
    bad = [r for r in kept[0].collect() if r["doc_id"] not in left][0]
    rows = [r.asDict() | {"doc_id": None} for r in kept[0].collect()] + [bad.asDict() | {"doc_id": good["doc_id"]}]
    docs = kept[0].unionByName(spark.createDataFrame(rows, kept[0].schema)).repartition(3)
    got = corpus_pipeline.quality(spark, docs, SF).select("doc_id", "text").collect()
    want = [(r["doc_id"], r["text"]) for r in kept[1].collect()]
    assert Counter(map(tuple, got)) == Counter(want + [(None, t) for _, t in want])


def documents(spark, rows):
    table = [(i, t, "en", "web", len(t)) for i, t in rows]
    return spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def test_near_copies_with_null_and_repeated_ids(spark):
    a, b, c, d = (" ".join(f"{w}{i}" for i in range(60)) for w in "abcd")
    near = a + " more"
    rows = [(8, a), (8, a), (None, a), (9, near), (None, near), (None, b), (None, b), (3, c), (3, d), (None, ""), (None, "")]
    got = corpus_pipeline.near_copies(spark, documents(spark, rows), SF).select("doc_id", "text").collect()
    assert Counter(map(tuple, got)) == Counter([(8, a), (None, b), (3, c), (3, d), (None, ""), (None, "")])


def test_repeated_passages_with_null_and_repeated_ids(spark):
    p, q = (" ".join(f"{w}{i}" for i in range(40)) for w in "pq")
    rows = [(None, f"one {p} end"), (7, f"two {p} end"), (7, f"three {p} end"), (None, f"four {q} end"), (None, f"five {q} end"), (9, f"six {p} end")]
    got = corpus_pipeline.repeated_passages(spark, documents(spark, rows), SF).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert [r["doc_id"] for r in got if p in r["text"]] == [7]
    assert [r["doc_id"] for r in got if q in r["text"]] == [None]


@pytest.mark.parametrize("stage", range(5))
def test_stages_on_an_empty_table(spark, stage):
    empty = documents(spark, [(1, "a")]).limit(0)
    out = corpus_pipeline.STAGES[stage][1](spark, empty, SF)
    assert out.collect() == []
    if stage < 4:
        assert out.dtypes == empty.dtypes


@pytest.mark.parametrize("stage", range(4))
def test_stages_leave_other_columns_alone(spark, stage):
    texts = [" ".join(f"{w}{i}" for i in range(80)) for w in "abcdef"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0] + " and more"), (3, "")]
    names = ["_row", "copies", "_copies", "_taken", "n_bytes", "kept_text", "predicted", "component_id", "_Bad", "_key", "size"]
    docs = documents(spark, rows).select("*", *[F.lit(f"own {n}").alias(n) for n in names])
    out = corpus_pipeline.STAGES[stage][1](spark, docs, SF)
    assert out.dtypes == docs.dtypes
    got = out.collect()
    assert got and all(r[n] == f"own {n}" for r in got for n in names)
    assert {r["text"] for r in got} <= set(texts) | {"", texts[0] + " and more", " and more"}


def test_mixing_and_packing_with_null_and_repeated_ids(spark):
    rows = [(None, f"text {i} " * 20) for i in range(30)] + [(4, "one two three " * 30)] * 3 + [(5, None), (None, None), (6, "")]
    docs = documents(spark, [(i, t or "") for i, t in rows]).withColumn("text", F.when(F.col("text") != "", F.col("text")))
    mixed = corpus_pipeline.source_weights(spark, docs, SF)
    words = lambda df: sum(len((r["text"] or "").split()) for r in df.collect())
    assert words(mixed) == pytest.approx(1.5 * words(docs), rel=0.1)
    again = corpus_pipeline.source_weights(spark, docs.repartition(2), SF)
    assert Counter(map(tuple, mixed.collect())) == Counter(map(tuple, again.collect()))
    assert max(Counter(map(tuple, mixed.where("text IS NULL AND doc_id IS NOT NULL").collect())).values(), default=0) <= 2
    pieces = corpus_pipeline.packing(spark, mixed, SF).collect()
    assert sum(r["piece"] == 0 for r in pieces) == mixed.count()


def test_run_is_its_stages(spark, kept):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == kept[5].columns
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert Counter(map(key, got.collect())) == Counter(map(key, kept[5].collect()))


def test_entry_stands_alone(tmp_path):
    """The entry imports without this package, or without a library that only this package needs."""
    import subprocess
    import sys

    root = Path(corpus_pipeline.__file__).parent
    for name in ("__spark_entry__.py", "shelfmark", "corpus_pipeline.py"):
        (tmp_path / name).symlink_to(root / name)
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith(WHAT): raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "print(len(e.queries()), 'pipeline' in e.queries())\n"
    )
    for gone in ("shelfmark.llm", "corpus_pipeline", "tokenizers", "ahocorasick"):
        without = subprocess.run([sys.executable, "-c", f"WHAT = {gone!r}\n{code}"], cwd=tmp_path, capture_output=True, text=True)
        assert without.returncode == 0 and "False" in without.stdout and "without the training-data" in without.stderr, gone
