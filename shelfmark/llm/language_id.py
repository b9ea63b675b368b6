"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

Weights are trained by follow-the-regularised-leader (proximal, per coordinate) with an
elastic-net penalty, which keeps most of them at zero; a temperature fitted on documents
that the weights have not seen makes the scores probabilities to be trusted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import BASE, U64, held_out, mix

BITS = 15
ORDERS = (1, 2, 3)
UNDECIDED = "und"


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, count) of the character n-grams of a text in lower case; buckets are hashes."""
    chars = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    codes = []
    for n in ORDERS:
        if len(chars) < n:
            break
        h = np.full(len(chars) - n + 1, n, np.uint64)
        for k in range(n):
            h = (h ^ chars[k : len(chars) - n + 1 + k]) * BASE
        codes.append(mix(h) >> U64(64 - BITS))
    if not codes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    counts = np.bincount(np.concatenate(codes).astype(np.int64), minlength=1 << BITS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def vector(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF values of length one; term frequencies are damped by a logarithm."""
    x = (1 + np.log(counts)) * idf[at]
    norm = np.sqrt((x * x).sum())
    return x / norm if norm else x


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all rows of `texts` (column text) each bucket occurs, and the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found[ngram_counts(text or "")[0]] += 1
                rows += 1
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(found[at], rows), pa.int64())], ["bucket", "n"]
        )

    out = np.zeros(1 << BITS, np.int64)
    rows = 0
    for bucket, n in texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        if bucket < 0:
            rows = n
        else:
            out[bucket] = n
    return out, rows


@dataclass
class LanguageModel:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets x labels
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        """The likeliest label and its probability; `und`, 0 for a text without a letter."""
        if not self.labels or text is None or not any(map(str.isalpha, text)):
            return UNDECIDED, 0.0
        at, counts = ngram_counts(text)
        logits = (vector(at, counts, self.idf) @ self.weights[at] + self.bias) / self.temperature
        p = np.exp(logits - logits.max())
        best = int(p.argmax())
        return self.labels[best], float(p[best] / p.sum())


def ftrl(
    rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, epochs: int = 4,
    alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02, seed: int = 0,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights (buckets x classes) and bias by FTRL-proximal over sparse rows (buckets, values)."""
    z, n = np.zeros((2, 1 << BITS, classes))
    bias, bias_n = np.zeros((2, classes))

    def weights(at: np.ndarray | slice) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1, 0)
        return -shrunk / ((beta + np.sqrt(n[at])) / alpha + l2)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, x = rows[i]
            w = weights(at)
            logits = x @ w + bias
            p = np.exp(logits - logits.max())
            error = p / p.sum()
            error[y[i]] -= 1
            g = x[:, None] * error[None, :]
            new = n[at] + g * g
            z[at] += g - (np.sqrt(new) - np.sqrt(n[at])) / alpha * w
            n[at] = new
            bias_n += error * error
            bias -= alpha * error / (beta + np.sqrt(bias_n))
    return weights(slice(None)), bias


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least negative log-likelihood, by golden-section search on its logarithm."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        s = logits / np.exp(t)
        s = s - s.max(1, keepdims=True)
        return float((np.log(np.exp(s).sum(1)) - s[np.arange(len(y)), y]).mean())

    lo, hi, g = -4.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(50):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def train(docs: DataFrame, per_label: int = 1200) -> LanguageModel:
    """Fit on `docs` (text, label, id), whose held-out rows and null labels are left aside.

    Document frequencies are those of all remaining rows. Weights are fitted on a sample
    of at most `per_label` rows of each label, drawn by a hash of id and text; every fifth
    of them serves the temperature instead.
    """
    rows = docs.where(F.col("label").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id"))).select("id", "text", "label")
    found, total = document_frequencies(rows)
    idf = np.log((1 + total) / (1 + found)) + 1
    # Of a frequent label only some rows take part in the draw at all, three times as many as it takes.
    draw, parts, keep = F.xxhash64("id", "text"), 1_000_000, F.lit(False)
    for label, n in rows.groupBy("label").count().collect():
        keep = keep | ((F.col("label") == label) & (F.pmod(draw, F.lit(parts)) * n < F.lit(3 * per_label * parts)))
    first = Window.partitionBy("label").orderBy(draw, "id")
    drawn = rows.where(keep).withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= per_label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [ngram_counts(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("_r"), pa.array([a.astype("<u2").tobytes() for a, _ in counts], pa.binary()),
                 pa.array([c.astype("<u4").tobytes() for _, c in counts], pa.binary())],
                ["label", "_r", "at", "n"],
            )

    sample = drawn.select("text", "label", "_r").mapInArrow(run, "label string, _r int, at binary, n binary").collect()
    sample.sort(key=lambda r: (r["label"], r["_r"]))
    labels = sorted({r["label"] for r in sample})
    y = np.array([labels.index(r["label"]) for r in sample], int)
    vectors = []
    for r in sample:
        at = np.frombuffer(r["at"], "<u2").astype(np.int64)
        vectors.append((at, vector(at, np.frombuffer(r["n"], "<u4"), idf)))
    aside = np.array([r["_r"] % 5 == 0 for r in sample], bool)
    learn = np.flatnonzero(~aside)
    weights, bias = ftrl([vectors[i] for i in learn], y[learn], max(1, len(labels)))
    unseen = np.flatnonzero(aside)
    logits = np.array([vectors[i][1] @ weights[vectors[i][0]] + bias for i in unseen]).reshape(len(unseen), len(bias))
    return LanguageModel(labels, idf, weights.astype(np.float32), bias, fit_temperature(logits, y[unseen]))


def language_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", per_label: int = 1200) -> DataFrame:
    """(id, held_out, lang_pred, score) of every document, from its whole text alone.

    Null texts and texts without a letter are `und` with score 0, and so are all texts if
    there was nothing to learn from. Repeated rows stay; a null id stays and counts as
    an empty one; other columns are dropped; an empty table gives an empty one.
    """
    lean = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), docs[label_col].cast("string").alias("label"))
    model = train(lean, per_label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                [id_col, "held_out", "lang_pred", "score"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    marked = lean.select("id", "text", held_out(F.col("id")).alias("held_out"))
    return marked.mapInArrow(run, f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double")
