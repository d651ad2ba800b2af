"""Quality classifier: a sparse rule ensemble over statistics of a text.

Small regression trees are boosted on a bounded sample of labelled rows. Every
path from a root to a node is a rule, a conjunction of comparisons. A logistic
model with an L1 penalty weighs the rules, most of which get weight 0, and those
that are left become one Spark column expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.quality_rules import statistics
from quillon.session import materialise

#: Labelled rows that the model is fitted on at most: those with the smallest hashes of their ids.
TRAIN_ROWS = 20_000
THRESHOLD = 0.3

#: (feature, "<=" or ">", threshold)
Condition = tuple[str, str, float]
Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class Model:
    """bias plus the sum of the weights of the rules that hold, through the logistic function."""

    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        features = feature_columns()
        total = F.lit(float(self.bias))
        for rule, weight in self.rules:
            holds = F.lit(True)
            for name, side, at in rule:
                holds = holds & (features[name] <= at if side == "<=" else features[name] > at)
            total = total + F.when(holds, float(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def feature_columns() -> dict[str, Column]:
    """Features over the columns of statistics()."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / n,
        "symbols": F.col("n_symbols") / n,
        "symbol_runs": F.col("n_symbol_runs") / n,
        "bars": F.col("n_bars") / n,
        "bangs": F.col("n_bangs") / n,
        "capitals": F.col("n_upper") / chars,
        "repeated_lines": F.col("n_dup_lines") / lines,
        "repeated_words": F.col("n_repeat_words") / n,
        "line_words": F.col("n_words") / lines,
    }


class _Trees:
    """Least-squares trees on features cut at quantiles."""

    def __init__(self, x: np.ndarray, depth: int = 3, cuts: int = 32, leaf: int = 20) -> None:
        self.depth, self.leaf = depth, leaf
        self.at = [np.unique(np.quantile(c, np.linspace(0, 1, cuts + 2)[1:-1])) for c in x.T]
        # Few labelled rows differ in a feature that is 0 for almost all; cut there too.
        self.at = [np.unique(np.concatenate([a, np.quantile(c[c > 0], [0.02, 0.1, 0.3, 0.5, 0.7, 0.9])])) if (c > 0).any() else a for a, c in zip(self.at, x.T, strict=True)]
        self.bin = np.stack([np.searchsorted(a, c, side="left") for a, c in zip(self.at, x.T, strict=True)], axis=1)

    def grow(self, residual: np.ndarray, rows: np.ndarray, path: tuple[tuple[int, str, float], ...], found: list, value: np.ndarray) -> None:
        if path:
            found.append(path)
        value[rows] = residual[rows].mean()
        if len(path) == self.depth or len(rows) < 2 * self.leaf:
            return
        r, best = residual[rows], (1e-9, -1, -1)
        total, n = r.sum(), len(rows)
        for f, at in enumerate(self.at):
            if not len(at):
                continue
            b = self.bin[rows, f]
            count, sums = np.bincount(b, minlength=len(at) + 1), np.bincount(b, weights=r, minlength=len(at) + 1)
            nl, sl = count.cumsum()[:-1], sums.cumsum()[:-1]
            nr = n - nl
            gain = np.where((nl >= self.leaf) & (nr >= self.leaf), sl**2 / np.maximum(nl, 1) + (total - sl) ** 2 / np.maximum(nr, 1) - total**2 / n, 0)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), f, k)
        if best[1] < 0:
            return
        _, f, k = best
        left = self.bin[rows, f] <= k
        self.grow(residual, rows[left], (*path, (f, "<=", float(self.at[f][k]))), found, value)
        self.grow(residual, rows[~left], (*path, (f, ">", float(self.at[f][k]))), found, value)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit(x: np.ndarray, y: np.ndarray, names: list[str], trees: int = 24, rate: float = 0.3, penalty: float = 2e-3, steps: int = 400) -> Model:
    """The model for rows x of features with labels y (0 or 1). Without both classes, the smoothed share of label 1 alone."""
    n = len(y)
    share = (y.sum() + 1) / (n + 2)
    bias = float(np.log(share / (1 - share)))
    if n == 0 or y.min() == y.max():
        return Model(bias, ())
    rng = np.random.default_rng(7)
    grower = _Trees(x, leaf=max(2, min(20, n // 50)))
    logit = np.full(n, bias)
    paths: list[tuple] = []
    for _ in range(trees):
        rows = rng.choice(n, size=max(2, n // 2), replace=False)
        value = np.zeros(n)
        grown: list[tuple] = []
        residual = y - _sigmoid(logit)
        grower.grow(residual, np.sort(rows), (), grown, value)
        paths += grown
        logit = logit + rate * 4 * value
    unique = list(dict.fromkeys(paths))

    def holds(path: tuple) -> np.ndarray:
        out = np.ones(n, bool)
        for f, side, at in path:
            out &= x[:, f] <= at if side == "<=" else x[:, f] > at
        return out

    columns, kept, seen = [], [], set()
    for path in unique:
        c = holds(path)
        key = c.tobytes()
        if 0 < c.sum() < n and key not in seen:  # rules that hold for the same rows are one
            seen.add(key)
            columns.append(c)
            kept.append(path)
    z = np.stack(columns, axis=1).astype(np.float32) if columns else np.zeros((n, 0), np.float32)
    mean = z.mean(axis=0, dtype=np.float64)
    scale = np.maximum(np.sqrt(mean * (1 - mean)), 0.02)
    z -= mean.astype(np.float32)
    z /= scale.astype(np.float32)
    # FISTA on the mean logistic loss with an L1 penalty; the bias is free of it.
    w, b, v, vb, t = np.zeros(z.shape[1]), bias, np.zeros(z.shape[1]), bias, 1.0
    vec = np.full(z.shape[1], 1 / np.sqrt(max(1, z.shape[1])))
    for _ in range(20):
        vec = z.T @ (z @ vec)
        vec /= max(1e-12, np.linalg.norm(vec))
    step = 1 / (0.25 * max(1.0, float(vec @ (z.T @ (z @ vec))) / n) * 1.1 + 0.25)
    for _ in range(steps if z.shape[1] else 0):
        g = _sigmoid(z @ v + vb) - y
        nw = v - step * (z.T @ g) / n
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * penalty, 0)
        nb = vb - step * g.mean()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    real = w / scale
    rules = tuple((tuple((names[f], side, at) for f, side, at in path), float(c)) for path, c in zip(kept, real, strict=True) if abs(c) > 1e-4)
    return Model(float(b - (real * mean).sum()), rules)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def score(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """For each row of docs: doc_id, held_out, score (of label 1) and predicted.

    docs needs doc_id and text, labels doc_id and quality (0 or 1). Only the
    texts' statistics are inputs. The model is fitted on the train_rows labelled
    rows with the smallest hashes of their doc_id, none of them held out; a
    doc_id with several labels counts once, with the least. Null and empty texts
    are scored by the statistics of the empty text. Without labels of both
    kinds, all scores are the smoothed share of label 1. Rows with a null doc_id
    are scored and not held out. Repeated rows give repeated rows.
    """
    scored = statistics(docs.select("doc_id", "text")).withColumn("score", learn(docs, labels, train_rows).score())
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """The model from the labelled rows of docs; statistics are taken of these rows only."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("_y")).where("doc_id is not null and _y is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("_y").alias("_y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    known = materialise(known, 1)  # train_rows pairs of numbers at most: small enough to broadcast
    sample = docs.select("doc_id", "text").join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi")
    features = feature_columns()
    once = statistics(sample).select("doc_id", *[c.alias(k) for k, c in features.items()]).join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id"])
    rows = once.toPandas().sort_values("doc_id")  # train_rows rows at most
    return fit(rows[list(features)].to_numpy(np.float64), (rows["_y"].to_numpy() > 0).astype(np.float64), list(features))


def good_documents(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """docs without those that the classifier rejects (score below threshold). Columns are those of docs; no row is moved."""
    model = learn(docs, labels, train_rows)
    # A column that is not deterministic keeps the filter above the statistics; below, it would repeat them for every rule.
    rows = statistics(docs.select(F.struct("*").alias("_row"), "text"), "_row").withColumn("_at", F.monotonically_increasing_id())
    return rows.where((model.score() >= threshold) & (F.col("_at") >= 0)).select("_row.*")
