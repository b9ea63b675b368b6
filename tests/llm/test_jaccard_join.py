"""Similar sets against all pairs, components against a search, keys against their promise."""

from __future__ import annotations

import random
import re
from fractions import Fraction

import numpy as np
import pytest

from shelfmark.llm import jaccard_join
from shelfmark.llm.common import mix
from shelfmark.llm.graph import components
from shelfmark.llm.jaccard_join import Sketches, merged, part_keys, similar_sets, sketch


def plain_components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def plain_sets(rows, size):
    out = {}
    for doc, text, *_ in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        out[doc] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    return out


def texts(seed):
    rng = random.Random(seed)
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "one"), (4, "ONE"), (5, "One two"), (6, "one  two"), (7, "É é"), (8, "é é")]
    common = [f"c{i}" for i in range(30)]
    for group in range(12):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([6, 12, 40, 150, 400]))]
        for _ in range(14):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, len(base) // 40, len(base) // 15])):
                words[rng.randrange(len(words))] = f"x{rng.randint(0, 3)}"
            if rng.random() < 0.3:
                words += common[: rng.randint(1, 30)]
            rows.append((len(rows), " ".join(words)))
    rows += [(900 + i, " ".join(common)) for i in range(60)]  # many copies
    return rows


@pytest.mark.parametrize("size,percent,seed", [(3, 90, 1), (5, 80, 2), (2, 60, 3)])
def test_against_all_pairs(spark, size, percent, seed):
    rows = texts(seed)
    sets = plain_sets(rows, size)
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and sets[b]]
    want = plain_components(list(sets), links)
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, n long").repartition(4)
    got = similar_sets(docs, size, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {d: (len(sets[d]), want[d]) for d in sets}
    assert len(links) > 500


def test_odd_tables(spark):
    rows = [(None, "a b c d e f", 1), (None, "a b c d e f", 1), (3, "a b c d e f", 2), (3, "a b c d e f", 2), (9, "A b c d e f", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component int")
    assert sorted(map(tuple, similar_sets(docs).collect()), key=repr) == sorted(
        [(None, 2, None)] * 2 + [(3, 2, 3)] * 2 + [(9, 2, 3)], key=repr
    )
    assert similar_sets(docs.limit(0)).collect() == []


@pytest.mark.parametrize("t", [Fraction(9, 10), Fraction(4, 5), Fraction(1, 2)])
def test_no_similar_pair_lacks_a_key(t):
    rng = np.random.default_rng(5)
    for n in [2, 3, 5, 8, 9, 10, 17, 60, 300, 2500]:
        for _ in range(15):
            union = mix(rng.integers(1, 1 << 62, n).astype(np.uint64))
            apart = int(len(union) * (1 - t))  # the most that may differ
            k = rng.integers(0, apart + 1)
            a, b = np.sort(union[: n - k]), np.sort(union[apart - k :])
            assert len(np.intersect1d(a, b)) >= t * n
            if len(a) and len(b) and not np.array_equal(a, b):
                assert len(np.intersect1d(part_keys(a, t), part_keys(b, t))), (n, k)


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(90), rng.randrange(90)) for _ in range(50)] + [(500, i) for i in range(501, 700)]
    want = plain_components({n for x in links for n in x}, links)
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert all(got.get(n, n) == c for n, c in want.items()) and set(got) <= set(want)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("small", [True, False])
def test_sketches_never_overstate_a_difference(small):
    rng = np.random.default_rng(3)
    sizes = [(10, 12), (600, 610), (3000, 2700), (9000, 4000), (90, 91), (361, 363)]
    unions = [mix(rng.integers(1, 1 << 62, n + m // 9 + 5).astype(np.uint64)) for n, m in sizes]
    pairs = [(np.unique(u[:n]), np.unique(u[len(u) - m :])) for u, (n, m) in zip(unions, sizes)]
    sets = [x for p in pairs for x in p]
    both = Sketches([sketch(x, small) for x in sets], np.array([len(x) for x in sets]), Fraction(1, 4))
    for k, (a, b) in enumerate(pairs):
        rows, place = both.at(int(min(both.size[2 * k], both.size[2 * k + 1])))
        apart = np.bitwise_count(rows[place[2 * k]] ^ rows[place[2 * k + 1]]).sum()
        assert 0 < apart <= len(np.setxor1d(a, b))


def test_close_sets_are_never_left_out():
    rng = np.random.default_rng(5)
    for t in (Fraction(4, 5), Fraction(9, 10), Fraction(3, 10)):
        sets, similar = [], []
        for _ in range(300):
            n = int(rng.integers(1, 900))
            base = mix(rng.integers(1, 1 << 62, n).astype(np.uint64))
            kept = base[rng.random(n) < rng.choice([0.2, 0.5, 0.8, 0.9, 0.97])]
            a, b = np.unique(base), np.unique(np.concatenate((kept, mix(rng.integers(1, 1 << 62, int(rng.integers(0, 5))).astype(np.uint64)))))
            if len(b):
                sets += [a, b]
                common = len(np.intersect1d(a, b))
                similar.append(common * t.denominator >= t.numerator * (len(a) + len(b) - common))
        left = np.arange(0, len(sets), 2)
        for small in (True, False):
            close = Sketches([sketch(x, small) for x in sets], np.array([len(x) for x in sets]), t).close(left, left + 1)
            assert all(close[similar]) and not all(close)


@pytest.mark.parametrize("t", [Fraction(4, 5), Fraction(9, 10)])
def test_large_sets_at_the_threshold_share_a_key(t):
    rng = np.random.default_rng(8)
    for n in (600, 1500, 3000, 9000):
        for _ in range(12):
            union = np.unique(mix(rng.integers(1, 1 << 62, n).astype(np.uint64)))
            gone = int(len(union) * (1 - t))
            left = int(rng.integers(0, gone + 1))
            union = rng.permutation(union)
            a, b = np.sort(union[left:]), np.sort(union[: len(union) - (gone - left)])
            assert len(np.intersect1d(a, b)) >= t * len(union)
            shared = len(np.intersect1d(part_keys(a, t), part_keys(b, t)))
            assert shared >= 10 and len(part_keys(a, t)) <= 1200
    a, b = (np.unique(mix(rng.integers(1, 1 << 62, 5000).astype(np.uint64))) for _ in range(2))
    assert not len(np.intersect1d(part_keys(a, t), part_keys(b, t)))


@pytest.mark.parametrize("n", [300, 1200])
def test_sets_without_a_common_shingle_share_no_key(n):
    rng = np.random.default_rng(9)
    for t in (Fraction(9, 10), Fraction(4, 5)):
        keys = [part_keys(np.unique(mix(rng.integers(1, 1 << 62, n).astype(np.uint64))), t) for _ in range(600)]
        assert sum(map(len, keys)) > 600 * 10
        assert len(np.unique(np.concatenate(keys))) == sum(map(len, keys))


def test_shared_parts_grow_no_faster_than_the_sets():
    rng = np.random.default_rng(10)
    rows = {}
    for count in (200, 1600):
        keys = []
        for k in range(count):  # every twentieth with one near copy
            base = np.unique(mix(rng.integers(1, 1 << 62, 200).astype(np.uint64)))
            keys += [part_keys(base, Fraction(4, 5))] + [part_keys(base[3:], Fraction(4, 5))] * (k % 20 == 0)
        _, n = np.unique(np.concatenate(keys), return_counts=True)
        rows[count] = n[n > 1].sum()
    assert 0 < rows[1600] <= 9 * rows[200]


def test_parts_of_a_class_are_compared_as_one(spark):
    rng = random.Random(4)
    rows = [(key, node, node, 30) for key in range(60) for node in rng.sample(range(50), 30)]  # a class of 50
    rows += [(100 + key, node, node, 20) for key in range(40) for node in [500, *range(1000 + 19 * key, 1019 + 19 * key)]]
    members = spark.createDataFrame(rows, "key long, node long, component long, k long")
    got = [tuple(r) for r in merged(members).collect()]
    groups: dict = {}
    for key, node, component in got:
        assert node == component
        groups.setdefault(key, set()).add(node)
    parts: dict = {}
    for key, node, *_ in rows:
        parts.setdefault(key, set()).add(node)
    assert all(any(part <= group for group in groups.values()) for part in parts.values())
    pairs = lambda of: sum(len(x) ** 2 for x in of)
    assert pairs(groups.values()) <= 4 * pairs(parts.values())
    assert len([g for g in groups.values() if min(g) < 500]) <= 20


def test_pairs_of_a_class_grow_no_faster_than_its_sets(spark, monkeypatch):
    compared = []
    linked = jaccard_join.linked

    def counted(pairs, *rest):
        compared.append(pairs.distinct().count())
        return linked(pairs, *rest)

    monkeypatch.setattr(jaccard_join, "linked", counted)
    rng, rows = random.Random(11), []
    base = [f"w{k}" for k in range(150)]
    for doc in range(1000):  # from hardly to largely edited copies, like those of a page that very many hold
        words = list(base)
        for k in rng.sample(range(150), rng.randrange(7)):
            words[k] = f"x{rng.randrange(10**6)}"
        rows.append((doc, " ".join(words)))
    got = similar_sets(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert len(got) == 1000 and len({r["component_id"] for r in got}) < 600
    assert sum(compared) <= 4 * 1000, compared
