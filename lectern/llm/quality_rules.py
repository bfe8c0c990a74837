"""Quality classifier: a sparse rule ensemble over text statistics.

Statistics are Spark column expressions. Shallow trees are grown in numpy on a bounded sample of labelled rows; every path from a root becomes a conjunctive rule; logistic weights of the rules are fitted with an L1 penalty, which leaves a few; these compile to one Spark column expression, so scoring needs no Python.

A null or empty text has zero for all statistics and gets the score that the rules give these. Without both classes in the sample the score is the share of good labels. Of an id with several labels the highest counts, of several rows with that id the least statistics; rows without an id teach nothing. Rows are scored by themselves, repeated rows alike. Further columns stay; an input column that is named like an added one is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm import toxicity

SAMPLE = 2500
THRESHOLD = 0.3
TREES, DEPTH, PENALTY = 40, 3, 0.004


def statistics(text: Column) -> dict[str, Column]:
    """The statistics of a text, by name; all doubles."""
    t = F.coalesce(text, F.lit(""))
    n = F.length(t)
    tokens = F.filter(F.split(t, r"\s+"), lambda w: w != "")
    many = F.size(tokens)
    lines = F.filter(F.split(t, "\n"), lambda w: w != "")

    def share(pattern: str) -> Column:
        return _ratio(F.length(F.regexp_replace(t, pattern, "")), n)

    return {
        "chars": n.cast("double"),
        "words": many.cast("double"),
        "mean_word": _ratio(n - many, many),
        "distinct_words": _ratio(F.size(F.array_distinct(tokens)), many),
        "distinct_lines": _ratio(F.size(F.array_distinct(lines)), F.size(lines)),
        "line_chars": _ratio(n, F.size(lines)),
        "upper": share("[^A-Z]+"),
        "digits": share("[^0-9]+"),
        "symbols": share(r"[^#$%&*@!?|<>{}\[\]\\/=+_~^]+"),
        "stops": share(r"[^.,;:]+"),
    }


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0).cast("double")


@dataclass
class Rules:
    """A score is the logistic of intercept plus the weights of the rules that hold. A rule: list of (statistic, <= or >, bound)."""

    intercept: float
    rules: list[tuple[list[tuple[str, str, float]], float]] = field(default_factory=list)

    def expression(self, columns: dict[str, Column]) -> Column:
        total = F.lit(float(self.intercept))
        for terms, weight in self.rules:
            holds = reduce(lambda a, b: a & b, [columns[c] <= v if op == "<=" else columns[c] > v for c, op, v in terms])
            total = total + F.when(holds, F.lit(float(weight))).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))

    def score(self, docs: DataFrame, text: str = "text", name: str = "score") -> DataFrame:
        """Adds the score."""
        held = "_quality_statistics"
        used = sorted({c for terms, _ in self.rules for c, _, _ in terms})
        with_stats = docs.withColumn(held, F.struct(*(c.alias(k) for k, c in statistics(F.col(text)).items() if k in used or not used)))
        return with_stats.withColumn(name, self.expression({k: F.col(held)[k] for k in used})).drop(held)


def grow(X: np.ndarray, y: np.ndarray, w: np.ndarray, names: list[str], rng, depth: int = DEPTH) -> list[list[tuple[str, str, float]]]:
    """One tree on a random half of rows and statistics, by weighted Gini; all its paths, inner ones too."""
    rows = rng.choice(len(y), max(2, len(y) // 2), replace=False)
    columns = rng.choice(len(names), max(2, len(names) * 2 // 3), replace=False)
    paths: list[list[tuple[str, str, float]]] = []

    def split(rows: np.ndarray, path: list) -> None:
        if path:
            paths.append(path)
        if len(path) == depth or len(rows) < 20 or len(set(y[rows])) < 2:
            return
        best = (1e-9, None, None)
        total, good = w[rows].sum(), (w * y)[rows].sum()
        parent = good * (total - good) / total
        for c in columns:
            values = X[rows, c]
            for cut in np.unique(np.quantile(values, np.linspace(0.02, 0.98, 33))):
                left = values <= cut
                tl = w[rows][left].sum()
                if 0 < tl < total:
                    gl = (w * y)[rows][left].sum()
                    gain = parent - gl * (tl - gl) / tl - (good - gl) * (total - tl - good + gl) / (total - tl)
                    if gain > best[0]:
                        best = (gain, c, float(cut))
        if best[1] is not None:
            left = X[rows, best[1]] <= best[2]
            split(rows[left], [*path, (names[best[1]], "<=", best[2])])
            split(rows[~left], [*path, (names[best[1]], ">", best[2])])

    split(rows, [])
    return paths


def lasso(R: np.ndarray, y: np.ndarray, w: np.ndarray, penalty: float, steps: int = 1500) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty on all but the intercept, by accelerated proximal gradient."""
    w = w / w.sum()
    A = np.hstack([np.ones((len(y), 1)), R])
    step = 4.0 / (np.linalg.norm(A * np.sqrt(w)[:, None], 2) ** 2)
    theta = np.zeros(A.shape[1])
    ahead, t = theta.copy(), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(A @ ahead, -30, 30)))
        new = ahead - step * (A.T @ (w * (p - y)))
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - theta)
        theta, t = new, t_new
    return float(theta[0]), theta[1:]


def train(X: np.ndarray, y: np.ndarray, names: list[str], prior: float | None = None, seed: int = 11) -> Rules:
    """Learns rules from statistics and labels; prior: the share of label 1 outside the sample."""
    share = float(np.mean(y)) if len(y) else 0.0
    prior = share if prior is None else prior
    if not 0 < share < 1:
        return Rules(float(np.log(np.clip(prior, 1e-6, 1 - 1e-6) / (1 - np.clip(prior, 1e-6, 1 - 1e-6)))))
    rng = np.random.default_rng(seed)
    w = np.where(y == 1, prior / share, (1 - prior) / (1 - share))
    balanced = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    found: dict[bytes, list] = {}
    for _ in range(TREES):
        for path in grow(X, y, balanced, names, rng):
            holds = _holds(X, path, names)
            if 5 <= holds.sum() <= len(y) - 5:
                found.setdefault(np.packbits(holds).tobytes(), path)
    paths = list(found.values())
    if not paths:
        return Rules(float(np.log(prior / (1 - prior))))
    R = np.stack([_holds(X, p, names) for p in paths], 1).astype(float)
    intercept, weights = lasso(R, y, w, PENALTY * min(prior, 1 - prior))
    return Rules(intercept, [(p, float(v)) for p, v in zip(paths, weights, strict=True) if abs(v) > 1e-6])


def _holds(X: np.ndarray, path: list, names: list[str]) -> np.ndarray:
    return np.logical_and.reduce([X[:, names.index(c)] <= v if op == "<=" else X[:, names.index(c)] > v for c, op, v in path])


def fit(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, most: int = SAMPLE) -> Rules:
    """Fits to at most `most` labelled documents per class, by hash of the id; their statistics come from the same expressions that score."""
    ids, prior = toxicity.sample(labels, "quality", F.lit(True) if allowed is None else allowed, most)
    names = list(statistics(F.col("text")))
    if not ids:
        return train(np.zeros((0, len(names))), np.zeros(0), names, prior)
    few = docs.filter(docs["doc_id"].isin(list(ids))).select(docs["doc_id"].cast("long").alias("doc_id"), *(c.alias(k) for k, c in statistics(F.col("text")).items()))
    rows = sorted((r.doc_id, *r.s) for r in few.groupBy("doc_id").agg(F.min(F.struct(*names)).alias("s")).collect())
    return train(np.array([r[1:] for r in rows], float).reshape(-1, len(names)), np.array([ids[r[0]] for r in rows], int), names, prior)
