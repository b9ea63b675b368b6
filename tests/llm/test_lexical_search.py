"""Search of documents for items against scoring every pair."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from shelfmark.llm.lexical_search import lexical_search


def terms(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in held)
    total = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, []).extend(terms(text))
    out = []
    for item, wanted in asked.items():
        scores = []
        for i, c in held:
            score = 0
            for t in wanted:
                if t in c:
                    m = 25 + (75 * sum(c.values()) * n_docs) // total
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, n, i, -s) for n, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, rank int").repartition(7),
        spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, id int"),
    )


def corpus():
    draw = random.Random(3)
    words = [f"w{i}" for i in range(60)] + ["É", "naïve", "字", "A"]
    say = lambda n: draw.choice([" ", "-", "\n"]).join(draw.choices(words, weights=[64 - i for i in range(64)], k=n))
    docs = [(i, say(draw.randint(0, 40))) for i in range(300)] + [(7, "w1 w1"), (None, "w3 w4"), (None, "w3 w4"), (900, None), (901, ""), (902, "?!"), (903, say(30_000))]
    docs += [(1000 + i, "copy w59 w58") for i in range(30)]
    items = [(i, say(draw.randint(1, 12))) for i in range(40)] + [(50, "w1 w1 W1"), (51, None), (52, "nothing here"), (53, "W59 copy"), (54, "w2"), (54, "w3"), (None, "w5")]
    return docs, items


@pytest.mark.parametrize("k, limit", [(10, 500_000), (3, 60), (1, 100)])
def test_against_every_pair(spark, k, limit):
    docs, items = corpus()
    out = lexical_search(*frames(spark, docs, items), k=k, limit=limit)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, out.collect()), key=repr) == plain(docs, items, k)


def test_small_heaps_and_blocks_of_documents(spark, monkeypatch):
    monkeypatch.setattr("shelfmark.llm.lexical_search.WAITING", 20)
    monkeypatch.setattr("shelfmark.llm.lexical_search.CELLS", 50)
    docs, items = corpus()
    assert sorted(map(tuple, lexical_search(*frames(spark, docs, items)).collect()), key=repr) == plain(docs, items, 10)


def test_empty_tables(spark):
    docs, items = frames(spark, *corpus())
    assert lexical_search(docs.limit(0), items).collect() == []
    assert lexical_search(docs, items.limit(0)).collect() == []
    assert lexical_search(docs.where("text is null"), items).collect() == []
