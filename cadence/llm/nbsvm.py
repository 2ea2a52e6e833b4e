"""Quality classifier: naive Bayes support vectors over byte n-grams (operator 8).

A text's features are indicators of its distinct byte bigrams and (hashed) trigrams and of word
bigrams that repeat a word.  Each is scaled by its log-count
ratio between the classes; a linear model with squared hinge loss is fitted on them by dual coordinate descent, mixed
with the mean weight as usual for these models, and its margin is calibrated to a probability
by a logistic curve fitted on rows that the model was not fitted on.

The model is fitted in one task on at most ``sample`` labelled rows (those of the smallest hashes of their
ids), a fixed bound; every text is scored whole in a narrow pass.

Edge cases: a null or empty text has no features and gets the model's intercept; without labels of both classes every
score is 0.5; labels that are null or not 0/1 are not used; an id with both labels counts for both, of
rows that repeat an id the least text is learnt from, once;
an empty table gives no rows; columns other than id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, doc_text, keep_rows, utf8_buffer

SAMPLE = 8000
REPEATS = 1 << 17  # after 2^16 bigrams and 2^16 buckets of trigrams: indicators of a word pair that is one word twice
BUCKETS = REPEATS + 8
SCORES = "doc_id long, score double"
MIX = 0.5
EPOCHS = 15
COST = 1.0


def features(data: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Sorted distinct features of a text's bytes; ``seen`` is a zeroed scratch table, zeroed again."""
    d = data.astype(np.uint32)
    two = d[:-1] << 8 | d[1:]
    seen[two] = True
    if len(d) > 2:
        seen[65536 + ((two[:-1] << 8 | d[2:]) * np.uint32(2654435761) >> 16)] = True
    words = np.array(data.tobytes().split(), object)
    if len(words) > 1:
        twice = (words[1:] == words[:-1]).astype(bool)  # a word that follows itself, once, in runs, and in what share of the words
        if twice.any():
            seen[REPEATS] = True
            seen[REPEATS + 1] = (twice[1:] & twice[:-1]).any()
            seen[REPEATS + 2 + min(5, int(8 * twice.mean()))] = True
    out = np.flatnonzero(seen)
    seen[out] = False
    return out


class Model:
    """Weights by feature, intercept, and the logistic curve's slope and shift."""

    def __init__(self, weights: np.ndarray, shift: float, slope: float, bias: float):
        self.weights, self.shift, self.slope, self.bias = weights.astype(np.float32), shift, slope, bias

    def margin(self, own: np.ndarray) -> float:
        return float(self.weights[own].sum(dtype=np.float64)) / max(1, len(own)) ** 0.5 + self.shift

    def score(self, own: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(own) + self.bias, -30, 30))))

    def blob(self) -> bytes:
        return np.array([self.shift, self.slope, self.bias], "<f8").tobytes() + self.weights.astype("<f4").tobytes()

    @staticmethod
    def read(blob: bytes) -> Model:
        head = np.frombuffer(blob[:24], "<f8")
        return Model(np.frombuffer(blob[24:], "<f4"), *head)


def descend(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the squared hinge loss; the intercept is a constant feature."""
    w, b, alpha = np.zeros(BUCKETS), 0.0, np.zeros(len(rows))
    xs = [scale[r] / max(1, len(r)) ** 0.5 for r in rows]
    diag = np.array([float(x @ x) + 1.0 for x in xs]) + 0.5 / cost
    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            g = y[i] * (float(w[rows[i]] @ xs[i]) + b) - 1 + alpha[i] * 0.5 / cost[i]
            new = max(0.0, alpha[i] - g / diag[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[rows[i]] += step * xs[i]
                b += step
                alpha[i] = new
    return w, b


def curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve by Newton steps, with smoothed targets."""
    pos, neg = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([margins, np.ones(len(y))], 1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (t - p))
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model | None:
    """None without both classes."""
    y = np.where(labels == 1, 1.0, -1.0)
    if len(set(y.tolist())) < 2:
        return None
    pos, neg = np.ones(BUCKETS), np.ones(BUCKETS)
    for r, s in zip(rows, y):
        (pos if s > 0 else neg)[r] += 1
    ratio = np.log(pos / pos.sum()) - np.log(neg / neg.sum())
    cost = np.full(len(y), COST)

    def model(own: np.ndarray) -> tuple[np.ndarray, float]:
        w, b = descend([rows[i] for i in own], y[own], ratio, cost[own])
        w[np.abs(w) < 1e-10 * np.abs(w).max(initial=0.0)] = 0.0  # steps that cancelled: what rounding left has no sign
        w = MIX * w + (1 - MIX) * np.abs(w).mean() * np.sign(w)
        return w * ratio, b

    # margins of rows outside the fit calibrate the curve
    fold = np.arange(len(rows)) % 3
    margins = np.zeros(len(rows))
    for k in range(3):
        own = np.flatnonzero(fold != k)
        if len(set(y[own].tolist())) < 2:
            continue
        w, b = model(own)
        for i in np.flatnonzero(fold == k):
            margins[i] = w[rows[i]].sum() / max(1, len(rows[i])) ** 0.5 + b
    w, b = model(np.arange(len(rows)))
    return Model(w, b, *curve(margins, y))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, sample: int) -> DataFrame:
    """(doc_id, text, label) of at most ``sample`` labelled ids that ``learn`` allows: a bounded set, so it is broadcast to the documents.

    Of rows that repeat an id the least text counts, once; an id with both labels is two rows of the sample."""
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
              .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & learn).distinct()
              .orderBy(F.xxhash64("doc_id"), "label").limit(sample))
    return (doc_text(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
            .select("doc_id", "text", "label"))


def train(sample_rows: DataFrame) -> Model | None:
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS, bool)
        for b in batches:
            data, off = utf8_buffer(b.column(1))
            blobs = [features(data[off[i]:off[i + 1]], seen).astype("<i4").tobytes() for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(blobs, pa.binary())], names=["doc_id", "label", "own"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
        got.sort(key=lambda r: (zlib.crc32(str(r[0]).encode()), r[0], r[2]))
        m = fit([np.frombuffer(r[2], "<i4") for r in got], np.array([r[1] for r in got]))
        yield pa.RecordBatch.from_arrays([pa.array([m.blob()] if m else [], pa.binary())], names=["model"])

    rows = sample_rows.select("doc_id", "text", "label").mapInArrow(extract, "doc_id long, label int, own binary")
    got = rows.repartition(1).mapInArrow(learn, "model binary").collect()
    return Model.read(bytes(got[0].model)) if got else None


def scorer(docs: DataFrame, model: Model | None):
    """A function from an Arrow text column to scores; the model (half a MB, whatever the data) is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model.blob() if model else None)

    def scores(texts: pa.Array) -> list[float]:
        m = Model.read(shared.value) if shared.value else None
        seen = np.zeros(BUCKETS, bool)
        data, off = utf8_buffer(texts)
        return [m.score(features(data[off[i]:off[i + 1]], seen)) if m else 0.5 for i in range(len(texts))]
    return scores


def score(docs: DataFrame, model: Model | None, threshold: float = 0.7) -> DataFrame:
    """(doc_id, score, predicted) of every row."""
    bounded_batches(docs.sparkSession)
    scores = scorer(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores(b.column(1)), pa.float64())], names=["doc_id", "score"])

    return doc_text(docs).mapInArrow(run, SCORES).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: Model | None, threshold: float = 0.7) -> DataFrame:
    """The rows of at least ``threshold``, with all their columns; all of them without a model."""
    scores = scorer(docs, model)
    return keep_rows(docs, lambda texts: [s >= threshold for s in scores(texts)]) if model else docs
