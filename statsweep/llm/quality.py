"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

The statistics of a document are a few numbers per whole text. Random Fourier features of the standardised statistics
approximate a Gaussian kernel; each partition sums its normal equations (Z'Z, Z'y), the sums meet in one small matrix
whose size depends on the number of features only, and the ridge solution is calibrated by isotonic regression on the
training scores, counted in fixed bins.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save

STATS = ("log_words", "word_len", "long_words", "distinct", "upper", "digits", "symbols", "commas", "stops", "bangs", "pipes",
         "word_runs", "symbol_words", "lines", "distinct_lines", "non_ascii", "capital_words", "ends")
FEATURES = 192
BINS = 2000
THRESHOLD = 0.3
LETTERS = bytes(b for b in range(256) if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
UPPER, DIGITS, ASCII, SPACES = bytes(range(65, 91)), bytes(range(48, 58)), bytes(range(128)), b" \t\n\r\x0b\x0c"
SYMBOL_WORD = re.compile(rb"[^A-Za-z0-9\x80-\xff\s.,]{2,}(?=\s|$)")


def stats(text: str | None) -> list[float]:
    """The statistics named in ``STATS`` over a whole text; zeros for an empty one."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATS)
    size = len(raw)
    count = lambda table: (size - len(raw.translate(None, table))) / size
    letters = count(LETTERS)
    lines = raw.split(b"\n")
    kinds = len(set(words))
    return [math.log1p(n), math.log1p((size - n) / n), sum(len(w) > 20 for w in words) / n, kinds / n ** 0.9, count(UPPER) / max(letters, 1e-9),
            count(DIGITS), 1 - letters - count(DIGITS) - count(SPACES), raw.count(b",") / n, raw.count(b".") / n, raw.count(b"!") / n, raw.count(b"|") / n,
            sum(map(bytes.__eq__, words, words[1:])) / n, len(SYMBOL_WORD.findall(raw)) / n, math.log1p(len(lines)) / math.log1p(n),
            len(set(lines)) / len(lines), 1 - count(ASCII), len(re.findall(rb"(?:^|\s)[A-Z]", raw)) / n, float(raw.rstrip()[-1:] in b".!?")]


def document_stats(docs: DataFrame) -> DataFrame:
    """``doc_id, x`` per row of ``docs(doc_id, text, ...)``; ``x`` is the array of ``STATS``. A null text counts as empty."""

    def run(batches):
        for batch in batches:
            x = [stats(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, x array<double>")


class Model:
    def __init__(self, mean, scale, features: int, width: float, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.w = rng.standard_normal((len(mean), features)) / width
        self.b = rng.uniform(0, 2 * np.pi, features)
        self.beta = np.zeros(features + 1)
        self.steps, self.values = np.array([0.0]), np.array([0.0])  # calibration: score at or above a step has its value

    def z(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features, and a constant."""
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([np.cos(x @ self.w + self.b) * math.sqrt(2 / len(self.b)), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.z(x) @ self.beta, -0.5, 1.5)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.steps, self.values)


def isotonic(y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Rising means of the sums ``y`` over the counts ``n`` (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for s, c in zip(y, n):
        blocks.append([s, c, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s2, c2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s2, blocks[-1][1] + c2, blocks[-1][2] + k2]
    return np.concatenate([[s / c] * k for s, c, k in blocks]) if blocks else np.zeros(0)


def _batch(batch) -> tuple[np.ndarray, np.ndarray]:
    x = batch.column(0)
    return np.asarray(x.values if hasattr(x, "values") else x.combine_chunks().values).reshape(-1, len(STATS)), np.asarray(batch.column(1), float)


def _summed(rows: DataFrame, fold, n: int) -> np.ndarray:
    """Sum of ``fold(x, y)`` (a vector of fixed length ``n``) over all rows: in each partition, then in a few groups."""

    def part(batches):
        total = np.zeros(n)
        for batch in batches:
            if batch.num_rows:
                total += fold(*_batch(batch))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["v"])

    def add(batches):
        total = np.zeros(n)
        for batch in batches:
            for v in batch.column(0).to_pylist():
                total += np.frombuffer(v)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["v"])

    groups = max(1, math.isqrt(rows.rdd.getNumPartitions()))
    out = rows.mapInArrow(part, "v binary").repartition(groups).mapInArrow(add, "v binary").collect()
    return np.sum([np.frombuffer(r.v) for r in out], axis=0) if out else np.zeros(n)


def train(x: DataFrame, labels: DataFrame, label: str = "quality", features: int = FEATURES, width: float = 4.0, ridge: float = 1e-3, seed: int = 11) -> Model:
    """Fit on ``x(doc_id, x)`` and ``labels(doc_id, <label> 0/1)``; all labelled rows count, nulls are left out.

    Without labelled rows every score is 0.
    """
    lab = labels.where(f"doc_id IS NOT NULL AND {label} IN (0, 1)").groupBy("doc_id").agg(F.max(label).cast("double").alias("y"))
    rows = save(x.join(lab, "doc_id").select("x", "y"), "quality-training")
    k = len(STATS)
    s = _summed(rows, lambda x, y: np.concatenate([[len(y)], x.sum(0), (x * x).sum(0)]), 1 + 2 * k)
    n = max(1.0, s[0])
    mean = s[1:k + 1] / n
    model = Model(mean, np.sqrt(np.maximum(s[k + 1:] / n - mean * mean, 1e-8)) + 1e-3, features, width, seed)
    if not s[0]:
        return model
    d = features + 1

    def normal(x, y):
        z = model.z(x)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    s = _summed(rows, normal, d * d + d)
    model.beta = np.linalg.solve(s[:d * d].reshape(d, d) + ridge * n * np.diag([*[1.0] * features, 0.0]) / features, s[d * d:])

    def bins(x, y):
        at = ((model.raw(x) + 0.5) * (BINS / 2)).astype(int).clip(0, BINS - 1)
        return np.concatenate([np.bincount(at, y, BINS), np.bincount(at, minlength=BINS)])

    s = _summed(rows, bins, 2 * BINS)
    full = np.flatnonzero(s[BINS:])
    model.steps = (full + 0.5) / (BINS / 2) - 0.5
    model.values = isotonic(s[:BINS][full], s[BINS:][full])
    return model


def score_quality(x: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` per row of ``x(doc_id, x)``."""

    def run(batches):
        for batch in batches:
            v = batch.column(1)
            s = model.score(np.asarray(v.values).reshape(-1, len(STATS))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= threshold).astype("int32"))], names=["doc_id", "score", "predicted"])

    return x.select("doc_id", "x").mapInArrow(run, "doc_id bigint, score double, predicted int")


def classify_quality(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """Train on ``labels(doc_id, quality)`` and score every row of ``docs(doc_id, text, ...)``: ``doc_id, score, predicted``.

    Nothing but the text enters a score. Null and blank texts get the score of all-zero statistics. Rows with a
    repeated or null ``doc_id`` keep their own row; an empty ``docs`` gives an empty result.
    """
    x = save(document_stats(docs), "document-stats")
    return score_quality(x, train(x, labels, label))
