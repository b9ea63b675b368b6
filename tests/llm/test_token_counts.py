"""Token counts against the tokenizer library itself."""

from __future__ import annotations

import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import Row

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from shelfmark.llm.token_counts import Transducer, token_counts  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
BITS = ["a", "e", "th", "'", "'s", "'re", "'ll", "v", "r", " ", "  ", "\n", "\t", "é", "ß", "1", "23", ".", "!!", "中",
        "😀", " ", "　", "<|endoftext|>", "THE", "ing", "́", "²", "_", "$"]


def library(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]


def sample():
    rng = random.Random(7)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    return [*texts, "a" * 3000, " " * 2000, "ab cd" * 400, "'" * 1500, "中" * 900, "x" * 511 + " y", None, ""]


@pytest.mark.parametrize("limit", [350_000, 50])
def test_as_the_library_counts(limit):
    texts = sample()
    machine = Transducer(PATH, limit)
    for part in (texts[:200], texts[200:], texts):  # a small table is started anew between them
        n_bytes, n_tokens = machine.count_texts(pa.array(part, pa.string()))
        assert n_bytes.tolist() == [len((t or "").encode()) for t in part]
        assert n_tokens.tolist() == library(part)


def test_rows(spark):
    rows = [Row(doc_id=1, text="one two", n_tokens=9), Row(doc_id=1, text="one two", n_tokens=9),
            Row(doc_id=None, text=None, n_tokens=None), Row(doc_id=2, text="word " * 1025, n_tokens=0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, token_counts(docs, PATH).collect()), key=repr)
    assert got == [(1, 7, 2, False), (1, 7, 2, False), (2, 5125, 1026, True), (None, 0, 0, False)]
    assert token_counts(docs.limit(0), PATH).collect() == []


def test_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    want = dict(zip([r["doc_id"] for r in rows], library([r["text"] for r in rows])))
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts(docs, PATH).collect()} == want


KINDS = {
    "letters": lambda r: "".join(r.choices("abcdefghijklmnopqrstuvwxyzABC", k=1_000_000)),
    "one letter": lambda r: "a" * 1_000_000,
    "symbols": lambda r: "".join(r.choices("!#$%&()*+,-./:;<=>?@[]^_{|}~", k=1_000_000)),
    "CJK": lambda r: "".join(chr(r.randint(0x4E00, 0x9FA5)) for _ in range(333_000)),
    "base64": lambda r: "\n".join("".join(r.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", k=76)) for _ in range(13_000)),
    "blanks": lambda r: " " * 1_000_000,
}


@pytest.mark.parametrize("kind", KINDS)
def test_a_megabyte_of_unbroken_text(kind):
    rng = random.Random(3)
    text = KINDS[kind](rng)
    texts = ["before it", "some words " + text + " and after. ", text[:5000] + " x " + text[:300], "ab cd"]
    begin = time.monotonic()
    _, n_tokens = Transducer(PATH).count_texts(pa.array(texts, pa.string()))
    assert time.monotonic() - begin < 60
    assert n_tokens.tolist() == library(texts)
