"""Quality classifier: regularised quadratic discriminant analysis.

Each text becomes a vector of transformed document statistics.  Spark
sums counts, vectors and outer products per class over all labelled
rows; from these few numbers come class means and shrunken covariances.
A score is the posterior of class 1, from the difference of the two
Gaussian log densities, with Mahalanobis distances solved against
Cholesky factors computed once per model.

Defined cases: NULL text counts as empty and gets a score; a NULL label
or id is not learnt from; several labels of one document count as their
largest; with fewer than two labelled rows in a class every score is the
(smoothed) share of label 1.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freed, shielded, held_out, map_batches, stored, texts_of

#: Shrinkage of a class covariance towards the pooled one and the sphere.
TO_POOLED = 0.10
TO_SPHERE = 0.02
#: A document is kept (label 1) from this score on.
THRESHOLD = 0.3

FEATURES = ["log_words", "word_len", "distinct", "repeat_next", "upper", "lower", "digit",
            "stop_punct", "other_punct", "other_kinds", "space", "newline", "line_len",
            "line_repeat", "high", "entropy", "bare_words", "top_word"]

_CLASS = np.zeros((8, 256), np.float64)
_CLASS[0, ord("A"):ord("Z") + 1] = 1
_CLASS[1, ord("a"):ord("z") + 1] = 1
_CLASS[2, ord("0"):ord("9") + 1] = 1
for _c in b".,;:'\"-()?":
    _CLASS[3, _c] = 1
for _c in range(33, 127):
    if not chr(_c).isalnum() and not _CLASS[3, _c]:
        _CLASS[4, _c] = 1
for _c in b" \t\r\n\x0b\x0c":
    _CLASS[5, _c] = 1
_CLASS[6, 10] = 1
_CLASS[7, 128:] = 1


def _odds(x: float, eps: float = 0.005) -> float:
    return float(np.log((x + eps) / (1 - x + eps)))


def statistics(text: str | None) -> list[float]:
    """Statistics of one whole text, shares as smoothed log odds."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).astype(np.float64)
    upper, lower, digit, stop, other, space, newline, high = (_CLASS @ hist)
    words = raw.split()
    w = max(1, len(words))
    repeats = sum(map(eq, words, words[1:]))
    counts: dict[bytes, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    lines = [x for x in raw.split(b"\n") if x.strip()]
    letters = max(1.0, upper + lower)
    p = hist[hist > 0] / n
    bare = sum(1 for word in counts if not word[-1:].isalnum() and word[-1] < 128)
    return [
        float(np.log1p(len(words))),
        float(np.log1p((len(raw) - space) / w)),
        _odds(min(1.0, len(counts) / w)),
        _odds(repeats / w),
        _odds(upper / letters),
        _odds(lower / n),
        _odds(digit / n),
        _odds(stop / n),
        _odds(other / n),
        float(np.log1p(np.count_nonzero(hist[_CLASS[4] > 0]))),
        _odds(space / n),
        _odds(newline / n),
        float(np.log1p(len(raw) / max(1, len(lines)))),
        _odds(1 - len(set(lines)) / max(1, len(lines)) if lines else 0.0),
        _odds(high / n),
        float(-(p * np.log(p)).sum()),
        _odds(min(1.0, bare / max(1, len(counts)))),
        _odds(max(counts.values(), default=0) / w),
    ]


def statistics_matrix(texts: list) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(len(texts), len(FEATURES))


@dataclass
class Discriminant:
    """Means, Cholesky factors and log determinants of the two classes."""

    prior: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    means: list = field(default_factory=list)
    factors: list = field(default_factory=list)
    log_det: list = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.factors:
            return np.full(len(x), self.prior[1])
        z = (x - self.centre) / self.scale
        dens = []
        for k in (0, 1):
            y = self.factors[k] @ (z - self.means[k]).T
            dens.append(np.log(self.prior[k]) - 0.5 * self.log_det[k] - 0.5 * (y * y).sum(axis=0))
        return 1.0 / (1.0 + np.exp(np.clip(dens[0] - dens[1], -500, 500)))


def class_moments(rows: DataFrame, dims: int) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and outer-product sum per class, over every row of
    (label, feats); tasks pre-aggregate, a few hundred sums reach the driver."""
    def partial(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            label = np.asarray(batch.column(0).to_pylist(), np.int64)
            x = np.array(batch.column(1).to_pylist(), np.float64).reshape(len(label), dims)
            for k in np.unique(label):
                v = np.hstack([np.ones((int((label == k).sum()), 1)), x[label == k]])
                total[int(k)] = total.get(int(k), 0) + v.T @ v
        for k, m in total.items():
            flat = m.ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * len(flat), pa.int32()), pa.array(range(len(flat)), pa.int32()),
                 pa.array(flat, pa.float64())], names=["label", "cell", "value"])

    sums = (rows.select("label", "feats").mapInArrow(partial, "label int, cell int, value double")
            .groupBy("label", "cell").agg(F.sum("value").alias("value")).collect())
    out = {}
    for k in {r["label"] for r in sums}:
        m = np.zeros((dims + 1) ** 2)
        for r in sums:
            if r["label"] == k:
                m[r["cell"]] = r["value"]
        m = m.reshape(dims + 1, dims + 1)
        out[k] = (m[0, 0], m[0, 1:], m[1:, 1:])
    return out


def fit(rows: DataFrame, dims: int = len(FEATURES), to_pooled: float = TO_POOLED,
        to_sphere: float = TO_SPHERE) -> Discriminant:
    """Fit on all rows of (label 0/1, feats)."""
    moments = class_moments(rows, dims)
    counts = np.array([moments[k][0] if k in moments else 0.0 for k in (0, 1)])
    prior = (counts + 1) / (counts.sum() + 2)
    model = Discriminant(prior, np.zeros(dims), np.ones(dims))
    if counts.min() < 2:
        return model
    n = counts.sum()
    model.centre = sum(moments[k][1] for k in (0, 1)) / n
    var = sum(np.diag(moments[k][2]) for k in (0, 1)) / n - model.centre ** 2
    model.scale = np.sqrt(np.maximum(var, 1e-8))
    covs = []
    for k in (0, 1):
        c, s, o = moments[k]
        mean = s / c
        covs.append((o / c - np.outer(mean, mean)) / np.outer(model.scale, model.scale))
        model.means.append((mean - model.centre) / model.scale)
    pooled = (counts[0] * covs[0] + counts[1] * covs[1]) / n
    for k in (0, 1):
        sphere = np.eye(dims) * max(np.trace(covs[k]) / dims, 1e-3)
        cov = (1 - to_pooled - to_sphere) * covs[k] + to_pooled * pooled + to_sphere * sphere
        chol = np.linalg.cholesky((cov + cov.T) / 2 + 1e-9 * np.eye(dims))
        model.factors.append(np.linalg.inv(chol))
        model.log_det.append(2 * float(np.log(np.diag(chol)).sum()))
    return model


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and statistics of every whole text."""
    def run(batch):
        x = statistics_matrix(texts_of(batch, text))
        return {"feats": pa.array(list(x), pa.list_(pa.float64()))}

    return map_batches(docs.select("doc_id", text), run, "feats array<double>", keep=["doc_id"])


def training_rows(feats: DataFrame, labels: DataFrame) -> DataFrame:
    """(label, feats) of labelled rows that are not held out."""
    gold = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
            .groupBy("doc_id").agg(F.max("quality").cast("int").alias("label")))
    return feats.filter(~held_out()).join(gold, "doc_id").select("label", "feats")


def train(docs: DataFrame, labels: DataFrame) -> tuple[Discriminant, DataFrame]:
    """The model and the stored statistics of all documents."""
    feats = stored(features(docs), "quality-stats")
    return fit(training_rows(feats, labels)), feats


def score(feats: DataFrame, model: Discriminant) -> DataFrame:
    """doc_id, score for stored statistics."""
    dims = len(FEATURES)

    def run(batch):
        x = np.array(texts_of(batch, "feats"), np.float64).reshape(batch.num_rows, dims)
        return {"score": pa.array(model.score(x), pa.float64())}

    return map_batches(feats, run, "score double", keep=["doc_id"])


def with_score(docs: DataFrame, model: Discriminant, name: str, text: str = "text") -> DataFrame:
    """Every column of ``docs`` plus the score ``name``; no shuffle."""
    def run(batch):
        return {name: pa.array(model.score(statistics_matrix(texts_of(batch, text))), pa.float64())}

    return map_batches(docs, run, f"`{name}` double", keep=docs.columns)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that the classifier does not reject, same columns."""
    with freed(docs.sparkSession):
        model, _ = train(docs.select("doc_id", "text"), labels)
    return shielded(docs, lambda d: with_score(d, model, "_quality_score").filter(
        F.col("_quality_score") >= threshold).drop("_quality_score"))


def op10(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model, feats = train(docs, labels)
    return score(feats, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
