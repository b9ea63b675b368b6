"""A quality classifier of conjunctive rules: paths of small trees, weighed by a lasso, run as columns."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import SPACES, WORD, held_out, stored
from shelfmark.llm.quality_rules import text_counts

#: The statistics that rules look at, from whole texts.
STATISTICS: dict[str, str] = {
    "words": "n_words",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "distinct": "n_distinct / greatest(n_words, 1)",
    "upper": "n_upper / greatest(word_chars, 1)",
    "digits": "n_digits / greatest(word_chars, 1)",
    "marks": "n_marks / greatest(n_words, 1)",
    "stops": "n_stops / greatest(n_words, 1)",
}

Condition = tuple[str, bool, float]  # statistic, True for "at most", threshold


@dataclass
class RuleModel:
    """score = logistic(bias + sum of the weights of the rules that hold)."""

    bias: float
    rules: list[tuple[tuple[Condition, ...], float]] = field(default_factory=list)

    def column(self) -> Column:
        """The score as a column over the statistics."""
        total = F.lit(self.bias)
        for conditions, weight in self.rules:
            holds = F.lit(True)
            for name, at_most, threshold in conditions:
                holds = holds & (F.col(name) <= threshold if at_most else F.col(name) > threshold)
            total = total + F.when(holds, F.lit(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """(id, `row_col` if any, one double column for each of STATISTICS); a null or empty text has zeros."""
    row = [row_col] if row_col else []
    text = F.coalesce(docs[text_col], F.lit(""))
    without = lambda chars: F.char_length(text) - F.char_length(F.translate(text, chars, ""))
    lean = docs.select(
        docs[id_col].alias("_id"),
        *row,
        docs[text_col].alias("_text"),
        F.size(F.array_distinct(F.split(F.btrim(text, F.lit(SPACES)), WORD.replace("[^", "[")))).alias("n_distinct"),
        without("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"),
        without("0123456789").alias("n_digits"),
        without("!?").alias("n_marks"),
        without(".").alias("n_stops"),
    )
    counts = text_counts(lean, "_text")
    return counts.select(F.col("_id").alias(id_col), *row, *[F.expr(e).cast("double").alias(f"s_{n}") for n, e in STATISTICS.items()])


def _paths(x: np.ndarray, y: np.ndarray, names: list[str], rng: np.random.Generator, depth: int, cuts: list[np.ndarray]) -> set:
    """The conjunctive rules on the paths of one tree, grown on a random half with random statistics at each node."""
    found: set[tuple[Condition, ...]] = set()

    def grow(rows: np.ndarray, path: tuple[Condition, ...]) -> None:
        if len(path) == depth or len(rows) < 20 or y[rows].min() == y[rows].max():
            return
        best = (0.0, -1, 0.0)
        mean = y[rows].mean()
        for j in rng.choice(len(names), min(4, len(names)), replace=False):
            below = x[rows, j][:, None] <= cuts[j][None, :]
            n, s = below.sum(0), (below * y[rows][:, None]).sum(0)
            m, t = len(rows) - n, y[rows].sum() - s
            ok = (n >= 5) & (m >= 5)
            gain = np.where(ok, s**2 / np.maximum(n, 1) + t**2 / np.maximum(m, 1) - len(rows) * mean**2, 0)
            if len(gain) and gain.max() > best[0] + 1e-9:
                best = (float(gain.max()), int(j), float(cuts[j][gain.argmax()]))
        if best[1] < 0:
            return
        _, j, cut = best
        for at_most in (True, False):
            longer = (*path, (names[j], at_most, cut))
            found.add(tuple(sorted(longer)))
            grow(rows[(x[rows, j] <= cut) == at_most], longer)

    grow(rng.choice(len(y), max(1, len(y) // 2), replace=False), ())
    return found


def _lasso_logistic(r: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Bias and weights that minimise mean logistic loss + penalty * |weights|, by accelerated proximal steps."""
    n, k = r.shape
    rate = 4 * n / max(1.0, np.linalg.norm(r, 2) ** 2 + n)
    w, bias = np.zeros(k), 0.0
    v, vb, t = w.copy(), bias, 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-np.clip(r @ v + vb, -50, 50))) - y
        step = v - rate * (r.T @ error) / n
        new = np.sign(step) * np.maximum(np.abs(step) - rate * penalty, 0)
        new_bias = vb - rate * error.mean()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / t_new * (new - w), new_bias + (t - 1) / t_new * (new_bias - bias)
        w, bias, t = new, new_bias, t_new
    return float(bias), w


def fit_rules(x: np.ndarray, y: np.ndarray, names: list[str], trees: int = 40, depth: int = 3, penalty: float = 1e-3, seed: int = 0) -> RuleModel:
    """Fit a rule ensemble. One class alone, or no rows, gives a constant score."""
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return RuleModel(float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    cuts = []
    for j in range(x.shape[1]):
        points = np.unique(np.quantile(x[:, j], np.linspace(0, 1, 41)))
        cuts.append((points[1:] + points[:-1]) / 2)
    paths: set[tuple[Condition, ...]] = set()
    for _ in range(trees):
        paths |= _paths(x, y, names, rng, depth, cuts)
    rules, at = sorted(paths), {n: j for j, n in enumerate(names)}
    holds = np.ones((len(y), len(rules)))
    for k, rule in enumerate(rules):
        for name, at_most, cut in rule:
            holds[:, k] *= (x[:, at[name]] <= cut) == at_most
    keys = {holds[:, k].tobytes(): k for k in reversed(range(len(rules)))}  # rules that hold for the same rows count once
    kept = sorted(keys.values())
    bias, weights = _lasso_logistic(holds[:, kept], y, penalty)
    return RuleModel(bias, [(rules[k], float(w)) for k, w in zip(kept, weights) if abs(w) > 1e-6])


def train(stats: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", sample: int = 12_000) -> RuleModel:
    """Fit on at most `sample` labelled documents, drawn by a hash of the id; held-out documents never enter.

    Labels other than 0 and 1, and ids with contradicting labels, teach nothing.
    """
    marks = (
        labels.select(labels[id_col].alias("_key"), labels[label_col].cast("int").alias("_y"))
        .where(F.col("_key").isNotNull() & F.col("_y").isin(0, 1) & ~held_out(F.col("_key")))
        .groupBy("_key")
        .agg(F.min("_y").alias("_y"), F.max("_y").alias("_most"))
        .where(F.col("_y") == F.col("_most"))
        .drop("_most")
    )
    names = [c for c in stats.columns if c != id_col]
    drawn = stats.join(marks, stats[id_col] == marks["_key"]).orderBy(F.xxhash64("_key"), "_key", *names).limit(sample)
    rows = np.array([tuple(r) for r in drawn.select("_y", *names).collect()], float).reshape(-1, 1 + len(names))
    return fit_rules(rows[:, 1:], rows[:, 0], names)


def quality_scores(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = 12_000, row_col: str | None = None) -> DataFrame:
    """(id, held_out, score, predicted) of every document; score is high where label 1 is likely.

    `row_col`, a number of the row where ids may be null or repeat, follows the id.

    Scores come from statistics of the whole text alone: equal texts score equal, and null
    texts as empty ones. Repeated rows stay, a null id stays and is not held out (its
    remainder is that of an empty text), other columns are dropped; an empty table gives
    an empty one, and no labels at all a score of 0.5 everywhere.
    """
    row = [row_col] if row_col else []
    stats = stored(statistics(docs, id_col, text_col, row_col))
    model = train(stats.drop(*row), labels, label_col, id_col, sample)
    scored = stats.select(F.col(id_col), *row, held_out(F.col(id_col)).alias("held_out"), model.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
