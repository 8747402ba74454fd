"""Quality classifier: regularised quadratic discriminant analysis over document statistics.

Each text gives FEATURES numbers (shares of character kinds, repetition, shape of lines and words),
transformed towards a normal shape. Both classes get a mean and a covariance that is shrunk towards
the pooled one and towards its diagonal; the score starts from the difference of the two Mahalanobis
log densities, computed with Cholesky factors that are inverted once, and a logistic curve turns it
into a probability.

Nothing is sampled: means and covariances come from sums over all labelled rows, and the shrinkage and
the curve are chosen from counts of out-of-fold differences. Sums and counts, not rows, come to the
driver; their number depends on FEATURES and BINS alone.

Defined cases: a null or empty text has the features of a text without characters and gets a score
like any other; labels of null are ignored; several labels of a doc_id count as 1 when at least half
of them are; rows with null doc_id are never labelled and never held out; without rows of both classes
every score is the share of label 1, smoothed by one row of each class (0.5 without labels); an empty
table gives an empty result; extra columns stay as they are in ``scored``.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import stored

FEATURES = 22
FOLDS = 3
SHRINKAGE = (0.05, 0.2, 0.5)
TO_DIAGONAL = 0.02
BIN, REACH = 0.25, 60.0
BINS = int(2 * REACH / BIN) + 1
_DIGITS, _UPPER, _LOWER = slice(48, 58), slice(65, 91), slice(97, 123)
_COMMON = [ord(c) for c in ".,;:'\"?()-"]
_ODD = [ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~!"]
_TINY = 2e-3


def features(text: str | None) -> np.ndarray:
    """Transformed statistics of one whole text."""
    data = (text or "").encode("utf-8", "replace")
    n = max(len(data), 1)
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256).astype(float)
    words = data.split()
    lines = data.split(b"\n")
    w, k = max(len(words), 1), len(lines)
    counts = Counter(words)
    line_counts = Counter(lines)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    p = seen[seen > 0] / n
    odd, upper, lower = seen[_ODD].sum(), seen[_UPPER].sum(), seen[_LOWER].sum()
    letters = max(upper + lower, 1.0)
    twice = sum(map(operator.eq, words, words[1:]))
    top = max(counts.values(), default=0)
    signs_at_end = sum(x[-1] in _ODD_BYTES for x in words)

    def share(x: float, of: float) -> float:
        return float(np.log(x / of + _TINY))

    return np.array([
        np.log1p(len(data)), np.log1p(len(words)), np.log1p(k),
        share(upper, letters), share(odd, n), share(seen[33], n), share(seen[124], n), share(seen[_COMMON].sum(), n), share(seen[_DIGITS].sum(), n),
        share(seen[128:].sum(), n), share(seen[10], n), share(seen[46], n),
        share(twice, w), share(top, w), share(len(counts), w), share(k - len(line_counts), k), share(max(line_counts.values()) - 1, k),
        float(lengths.mean()) if len(words) else 0.0, float(np.log1p(lengths.std())) if len(words) else 0.0,
        share(signs_at_end, w), float(-(p * np.log(p)).sum()), share(sum(x.isupper() for x in counts), max(len(counts), 1)),
    ])


_ODD_BYTES = frozenset(_ODD)


@dataclass
class Model:
    """Two Gaussians and a logistic curve, or a constant where a class is missing."""

    constant: float | None
    means: np.ndarray | None = None
    inverses: np.ndarray | None = None  # inverted Cholesky factors
    logs: np.ndarray | None = None  # half log determinants
    slope: float = 1.0
    offset: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 minus that of class 0."""
        logp = [-0.5 * (((x - self.means[c]) @ self.inverses[c].T) ** 2).sum(1) - self.logs[c] for c in (0, 1)]
        return logp[1] - logp[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(x) + self.offset, -700, 700)))


@dataclass
class Sums:
    """Rows, sum and sum of products of one class."""

    n: float
    total: np.ndarray
    products: np.ndarray

    def __sub__(self, other: Sums) -> Sums:
        return Sums(self.n - other.n, self.total - other.total, self.products - other.products)

    def moments(self) -> tuple[np.ndarray, np.ndarray]:
        mean = self.total / self.n
        return mean, self.products / self.n - np.outer(mean, mean)


def gaussians(classes: list[Sums], shrink: float) -> Model:
    n = sum(c.n for c in classes)
    if min(c.n for c in classes) < 2:
        return Model(constant=(classes[1].n + 1) / (n + 2))
    moments = [c.moments() for c in classes]
    pooled = sum(c.n / n * cov for c, (_, cov) in zip(classes, moments, strict=True))
    pooled += np.diag(np.maximum(np.diag(pooled), 1e-6)) * TO_DIAGONAL
    inverses, logs = [], []
    for _, cov in moments:
        mixed = (1 - shrink) * cov + shrink * pooled
        mixed = (1 - TO_DIAGONAL) * mixed + TO_DIAGONAL * np.diag(np.maximum(np.diag(mixed), 1e-6)) + 1e-9 * np.eye(len(mixed))
        factor = np.linalg.cholesky(mixed)
        inverses.append(np.linalg.inv(factor))
        logs.append(np.log(np.diag(factor)).sum())
    return Model(None, np.array([m for m, _ in moments]), np.array(inverses), np.array(logs))


def logistic(d: np.ndarray, label: np.ndarray, n: np.ndarray) -> tuple[float, float, float]:
    """Slope (not negative), offset and mean loss of the curve over weighted differences."""
    theta = np.array([0.5, 0.0])
    x = np.stack([d, np.ones_like(d)], 1)
    # one row of each class on the other side keeps the slope finite when the classes are apart
    x = np.concatenate([x, [[REACH / 4, 1], [-REACH / 4, 1]]])
    y, w = np.concatenate([label, [0, 1]]), np.concatenate([n, [0.5, 0.5]])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -35, 35)))
        gradient = x.T @ (w * (p - y))
        hessian = (x * (w * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        theta = theta - step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        theta[0] = max(theta[0], 0.0)
        if np.abs(step).max() < 1e-8:
            break
    p = np.clip(1 / (1 + np.exp(-np.clip(x @ theta, -35, 35))), 1e-12, 1 - 1e-12)
    loss = -(w * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / w.sum()
    return float(theta[0]), float(theta[1]), float(loss)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _features(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([features(t) for t in batch])


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def stored_features(docs: DataFrame) -> DataFrame:
    """doc_id and features of every row, stored: narrow, so later joins never move a text."""
    return stored(docs.select("doc_id", _features("text").alias("x")), "quality-features")


def labelled(table: DataFrame, labels: DataFrame) -> DataFrame:
    """fold, label and x of the rows that may be learned from (labels: doc_id, quality)."""
    one = labels.filter(F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        (F.avg("quality") >= 0.5).cast("int").alias("label")
    )
    fold = F.crc32(F.concat(F.lit("fold-"), F.col("doc_id").cast("string")).cast("binary")) % FOLDS
    return table.join(one, "doc_id").select(fold.cast("int").alias("fold"), "label", "x")


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for key, rows in batch.groupby(["fold", "label"]):
            x = np.stack(rows["x"].to_numpy())
            got = np.concatenate([[len(x)], x.sum(0), (x.T @ x).ravel()])
            out[key] = out.get(key, 0) + got
    for (fold, label), values in out.items():
        yield pd.DataFrame({"fold": fold, "label": label, "place": np.arange(len(values)), "value": values})


def _trials(models: dict[tuple[int, float], Model]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: Counter = Counter()
        for batch in batches:
            for (fold, label), rows in batch.groupby(["fold", "label"]):
                x = np.stack(rows["x"].to_numpy())
                for k, shrink in enumerate(SHRINKAGE):
                    model = models[int(fold), shrink]
                    if model.constant is None:
                        bins = np.rint(np.clip(model.difference(x), -REACH, REACH) / BIN).astype(int)
                        for b, n in zip(*np.unique(bins, return_counts=True), strict=True):
                            out[k, int(label), int(b)] += int(n)
        yield pd.DataFrame([(*key, n) for key, n in out.items()], columns=["trial", "label", "bin", "n"])

    return run


def fit(table: DataFrame, labels: DataFrame) -> Model:
    """Learn from stored features and labels; two passes over the labelled rows."""
    train = labelled(table, labels)
    sums = train.mapInPandas(_sums, "fold int, label int, place int, value double").groupBy("fold", "label", "place").agg(F.sum("value").alias("value"))
    width = 1 + FEATURES + FEATURES**2
    values = np.zeros((FOLDS, 2, width))
    for r in sums.collect():  # FOLDS * 2 * width numbers at most
        values[r["fold"], r["label"], r["place"]] = r["value"]

    def parts(v: np.ndarray) -> Sums:
        return Sums(v[0], v[1:1 + FEATURES], v[1 + FEATURES:].reshape(FEATURES, FEATURES))

    whole = [parts(values[:, c].sum(0)) for c in (0, 1)]
    if min(c.n for c in whole) < 2:
        return gaussians(whole, SHRINKAGE[0])
    models = {(f, s): gaussians([whole[c] - parts(values[f, c]) for c in (0, 1)], s) for f in range(FOLDS) for s in SHRINKAGE}
    counted = train.mapInPandas(_trials(models), "trial int, label int, bin int, n bigint").groupBy("trial", "label", "bin").agg(F.sum("n").alias("n"))
    rows = np.array([tuple(r) for r in counted.collect()], float).reshape(-1, 4)  # len(SHRINKAGE) * 2 * BINS rows at most
    if not len(rows):
        return gaussians(whole, SHRINKAGE[-1])
    curves = {int(k): logistic(rows[rows[:, 0] == k, 2] * BIN, rows[rows[:, 0] == k, 1], rows[rows[:, 0] == k, 3]) for k in np.unique(rows[:, 0])}
    best = min(curves, key=lambda k: (curves[k][2], k))
    model = gaussians(whole, SHRINKAGE[best])
    model.slope, model.offset, _ = curves[best]
    return model


def scorer(model: Model):
    """A pandas function from stored features to scores."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            yield pd.Series(model.score(np.stack(x.to_numpy())) if len(x) else [], dtype=float)

    return score


def scored(docs: DataFrame, model: Model, to: str = "quality_score") -> DataFrame:
    """All columns of ``docs`` and the score of its text."""
    return docs.withColumn(to, scorer(model)(_features("text")))
