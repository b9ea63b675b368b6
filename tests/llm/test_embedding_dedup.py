"""Near vectors against all pairs, and the estimates against what they estimate."""

from __future__ import annotations

import numpy as np
import pytest

from shelfmark.llm import embedding_dedup
from shelfmark.llm.embedding_dedup import banding, codes, estimates, near_vectors, unit
from tests.llm.test_jaccard_join import plain_components

BITS = 256


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(1)
    x, y = unit(rng.normal(size=(2000, 64))), unit(rng.normal(size=(200, 64)))
    y[:100] = unit(x[:100] + 0.05 * rng.normal(size=(100, 64)))
    guess, error = estimates(*codes(x, BITS), y, BITS)
    off = guess - x @ y.T
    assert abs(off.mean()) < 1e-3 and (np.abs(off) <= error[:, None]).mean() > 0.999
    assert np.abs(np.diag(off[:100])).max() < 0.1


def test_banding_keeps_its_promise():
    for n in (10, 10_000, 10**9):
        bits, bands = banding(n, 0.95, 0.98)
        agree = (1 - np.arccos(0.95) / np.pi) ** bits
        assert 1 - (1 - agree) ** bands >= 0.98


def plain(ids, x, cosine):
    c = x @ x.T
    pairs = [(ids[i], ids[j]) for i, j in zip(*np.nonzero(c >= cosine)) if i < j]
    return pairs, plain_components(ids, pairs)


@pytest.mark.parametrize("block", [512, 16])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(block)
    base = rng.normal(size=(150, 64))
    near = [b + s * rng.normal(size=64) for b in base[:40] for s in rng.choice([0.02, 0.1, 0.2], 4)]
    large = [base[140] + 0.05 * rng.normal(size=64) for _ in range(120)]
    x = np.array([*base, *near, *large, *[base[100]] * 60], np.float32)
    ids = [int(i) for i in rng.permutation(len(x))]
    docs = spark.createDataFrame([(i, v.tolist(), "x") for i, v in zip(ids, x)], "vec_id long, embedding array<float>, n string").repartition(4)
    got = {r["vec_id"]: r for r in near_vectors(docs).collect()}
    pairs, want = plain(ids, unit(x), 0.95)
    n = dict.fromkeys(ids, 0)
    for a, b in pairs:
        n[a], n[b] = n[a] + 1, n[b] + 1
    assert set(got) == set(ids) and all(got[i]["n_links"] <= n[i] for i in ids)  # no link below the threshold
    assert sum(r["n_links"] for r in got.values()) >= 0.98 * sum(n.values())
    assert np.mean([got[i]["component_id"] == want[i] for i in ids]) > 0.98
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


def test_codes_are_columns(spark):
    x = np.random.default_rng(5).normal(size=(9, 10))
    rows = [(i, 1, bytearray(v.astype("<f8").tobytes())) for i, v in enumerate(x)]
    nodes = spark.createDataFrame(rows, "node long, copies long, vec binary").repartition(2)
    signs, factors = codes(unit(x), 8 * 3)
    for r in embedding_dedup.banded(nodes, 8, 3).collect():
        code = np.unpackbits(np.frombuffer(r["signs"], np.uint8), count=30)
        assert code.tolist() == signs[r["node"]].tolist() and r["factor"] == pytest.approx(factors[r["node"]])
        assert r["bands"] == [int(code[k : k + 8] @ (1 << np.arange(8))) for k in (0, 8, 16)]


def test_odd_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, None]), (None, [1.0, 1.0]), (7, [1.0, 1.0]),
            (8, [2.0, 2.0]), (8, [2.0, 2.0]), (9, [1.0, 1.0, 1.0]), (10, [3e38, 3e38])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((tuple(r) for r in near_vectors(docs).collect()), key=repr)
    want = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, None, 9)] + [(7, 3, 7, True), (8, 3, 7, False), (8, 3, 7, False), (10, 3, 7, False)]
    assert got == sorted(want, key=repr)
    assert near_vectors(docs.limit(0)).collect() == []
