"""Packing: every token in one place, sequences gapless, and as few as the best loop finds."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from shelfmark.llm.packing import best_fit, cut, pack, text_ids  # noqa: E402
from tests.llm.test_token_counts import sample  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_ids_are_those_of_the_library():
    tokenizer = Tokenizer.from_file(PATH)
    for text in filter(None, sample()):
        assert text_ids(PATH).of(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("char", [" ", "\n", "\u3000"])
@pytest.mark.parametrize("run", [99_999, 100_000, 1_000_000])
def test_ids_of_long_white_space(char, run):
    text = "word" * 3_000 + char * run + "y"
    assert text_ids(PATH).of(text).tolist() == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def test_cut():
    assert cut(5, 8) == [(0, 5)] and cut(8, 8) == [(0, 8)] and cut(0, 8) == []
    assert cut(19, 8) == [(0, 3), (3, 8), (11, 8)]


def plain_best_fit(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        gaps.append((gaps.pop(gaps.index(min(fit))) if fit else capacity) - n)
    return len(gaps)


@pytest.mark.parametrize("seed", range(8))
def test_best_fit_against_one_by_one(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 64, 1024])
    lengths = [rng.randint(1, capacity) for _ in range(rng.choice([0, 1, 50, 900]))] + [max(1, capacity // 3)] * 40
    used, rank = defaultdict(list), Counter()
    for length, first, count, sequence, offset in best_fit(Counter(lengths), capacity):
        assert first == rank[length]
        rank[length] += count
        for i in range(count):
            used[sequence + i].append((offset, length))
    assert rank == Counter(lengths)
    for parts in used.values():
        ends = [0, *np.cumsum([n for _, n in sorted(parts)])]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= capacity
    assert len(used) <= 1.02 * plain_best_fit(lengths, capacity) + 1


@pytest.mark.parametrize("counts", [{1: 10**9}, {k: 10**9 // k**2 for k in range(1, 1024)}, {k: 10**6 for k in range(1, 33)}])
def test_runs_are_bounded(counts):
    runs = best_fit(counts, 1024)
    opened = Counter(r[0] for r in runs if r[4] == 0)
    assert max(opened.values()) == 1 and len(runs) <= 2 * len(counts) * 1024


def test_rows(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("the of and word") for _ in range(rng.randint(0, 90))) for _ in range(150)]
    rows = [(i, t, 5) for i, t in enumerate(texts)] + [(7, texts[7], 5), (None, None, None), (900, "", 1)]
    rows += [(1000 + i, "same text here", 1) for i in range(300)]  # one length holds most pieces
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    got = pack(docs.repartition(3), PATH, capacity=32).collect()
    tokenizer, seen = Tokenizer.from_file(PATH), Counter()
    wanted = Counter()
    for doc, text, _ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        for k, (s, n) in enumerate(cut(len(ids), 32)):
            wanted[doc, k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())] += 1
    sequences = defaultdict(list)
    for r in got:
        seen[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert seen == wanted
    for parts in sequences.values():
        ends = [0, *np.cumsum([n for _, n in sorted(parts)])]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 32
    assert len(sequences) <= 1.02 * plain_best_fit([r["length"] for r in got], 32) + 1
    assert pack(docs.limit(0), PATH).collect() == []
