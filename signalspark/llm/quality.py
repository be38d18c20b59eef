"""Operator 3, quality classifier by positive-unlabelled learning.

Trusted positives are labelled rows of the training folds with quality 1; the
unlabelled set is web text of the training folds whose labels are not looked at.
A linear scorer on style features minimises the non-negative unbiased risk

    prior * R(pos, +1) + max(0, R(unl, -1) - prior * R(pos, -1))

with the logistic loss, so its sigmoid estimates the chance of label 1. The class
prior is estimated first: a plain positive-versus-unlabelled scorer ranks held-back
rows of both sets, and the prior is the smallest upper bound, over score thresholds,
of the unlabelled share above the threshold divided by the positives' share.

Fitting uses bounded samples (``POSITIVES`` and ``UNLABELLED`` documents of smallest
hashed id); scoring covers every whole text, one pass, no shuffle.

Edge cases: null and empty texts have all-zero counts and are scored like any other; null ids
belong to the fold of the empty string; null labels are not positives; repeated label rows count
once per id; rows that repeat are each scored; without any positive or any unlabelled text there is
no model and every score is 0.5; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalspark.llm.common import hashed_sample
from signalspark.llm.grams import NOT_SPACE, text_buffers, texts_of_words, word_names, word_spans
from signalspark.llm.tokens import forget_encoders, small_batches

POSITIVES, UNLABELLED = 4000, 8000
THRESHOLD = 0.7
FOLDS, HELD_FOLD = 4, 2
#: hashed word shapes (case and symbol classes, runs collapsed)
SHAPES = 128
STYLE = 9
DIM = STYLE + SHAPES
SEED = 5_003


def held_out(key: str) -> Column:
    """The fold that fitting never sees."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == HELD_FOLD


_CLASS = np.full(256, 4, np.uint8)  # 0 space, 1 lower, 2 upper, 3 digit, 4 other symbol, 5 stop or comma
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
_CLASS[0x61:0x7B] = 1
_CLASS[0x80:] = 1
_CLASS[0x41:0x5B] = 2
_CLASS[0x30:0x3A] = 3
_CLASS[[0x2E, 0x2C]] = 5


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.float64)


def features(texts: pa.Array) -> np.ndarray:
    """A row of ``DIM`` features for each whole text: shares, so a text's length does not matter."""
    buf, offsets = text_buffers(texts)
    n = len(offsets) - 1
    out = np.zeros((n, DIM), np.float32)
    if not len(buf):
        return out
    kind = _CLASS[buf]
    size = np.diff(offsets).astype(np.float64)
    starts, ends = word_spans(buf, offsets, NOT_SPACE)
    first = texts_of_words(starts, offsets)
    owner = np.repeat(np.arange(n), np.diff(first))
    words = np.diff(first).astype(np.float64)
    some, letters = np.maximum(size, 1), _sums((kind == 1) | (kind == 2), offsets)
    out[:, 0] = _sums(kind == 4, offsets) / some
    out[:, 1] = _sums(kind == 2, offsets) / np.maximum(letters, 1)
    out[:, 2] = _sums(kind == 3, offsets) / some
    out[:, 3] = _sums(kind == 5, offsets) / np.maximum(words, 1)
    out[:, 4] = _sums(buf == 0x0A, offsets) / np.maximum(words, 1)
    out[:, 5] = size / np.maximum(words, 1)
    if len(starts):
        many = np.maximum(words, 1)
        out[:, 6] = np.bincount(owner, kind[ends - 1] == 4, n) / many
        out[:, 7] = np.bincount(owner, (ends - starts == 1) & (kind[starts] == 4), n) / many
        names = word_names(buf, starts, ends)
        same = np.zeros(len(names), bool)  # words equal to the one before
        same[1:] = (names[1:] == names[:-1]) & (owner[1:] == owner[:-1])
        out[:, 8] = np.bincount(owner, same, n) / many
        # word shapes: the first byte's class, the last byte's class, whether a symbol follows a letter inside, length class
        inner = np.concatenate([[0], np.cumsum((kind[1:] == 4) & (kind[:-1] != 4) & (kind[:-1] != 0))])
        turns = np.minimum(inner[ends - 1] - inner[starts], 1)
        shape = ((kind[starts].astype(np.int64) * 6 + kind[ends - 1]) * 2 + turns) % SHAPES
        counts = np.bincount(owner * SHAPES + shape, minlength=n * SHAPES).reshape(n, SHAPES)
        out[:, STYLE:] = counts / many[:, None]
    return np.sqrt(out)  # steadies the spread of small shares


@dataclass
class Model:
    """A linear scorer over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weight + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _adam(grad, dim: int, steps: int, rate: float) -> np.ndarray:
    w, m, v = np.zeros(dim), np.zeros(dim), np.zeros(dim)
    for t in range(1, steps + 1):
        g = grad(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def estimate_prior(pos: np.ndarray, unl: np.ndarray, delta: float = 0.1) -> float:
    """Share of positives among the unlabelled, from held-back scores of both (best-bin bound)."""
    thresholds = np.quantile(pos, np.linspace(0, 0.9, 91))
    p = (pos[None, :] >= thresholds[:, None]).mean(1)
    u = (unl[None, :] >= thresholds[:, None]).mean(1)
    slack = np.sqrt(np.log(4 / delta) / (2 * len(unl))) + np.sqrt(np.log(4 / delta) / (2 * len(pos)))
    best = np.argmin((u + slack) / p)
    return float(np.clip(u[best] / p[best], 0.02, 0.98))


def fit(pos: np.ndarray, unl: np.ndarray, steps: int = 800, rate: float = 0.02, l2: float = 1e-3) -> Model | None:
    """The non-negative risk minimiser; None without positives or unlabelled rows."""
    if not len(pos) or not len(unl):
        return None
    both = np.concatenate([pos, unl]).astype(np.float64)
    mean, scale = both.mean(0), both.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    std = lambda x: np.hstack([np.clip((x - mean) / scale, -8, 8), np.ones((len(x), 1))])
    pos, unl = std(pos.astype(np.float64)), std(unl.astype(np.float64))
    decay = np.append(np.full(pos.shape[1] - 1, l2), 0.0)

    def contrast(p, u):
        def grad(w):
            return (-(p.T @ (1 - _sigmoid(p @ w))) / len(p) + u.T @ _sigmoid(u @ w) / len(u)) / 2 + 10 * decay * w
        return _adam(grad, p.shape[1], 200, rate)

    half_p, half_u = pos[::2], unl[::2]
    w = contrast(half_p, half_u)
    held_p, held_u = (pos[1::2] if len(pos) > 1 else pos), (unl[1::2] if len(unl) > 1 else unl)
    prior = estimate_prior(held_p @ w, held_u @ w)

    def grad(w):
        sp, su = _sigmoid(pos @ w), _sigmoid(unl @ w)
        g_pos = -(pos.T @ (1 - sp)) / len(pos)  # loss of positives called positive
        g_neg = unl.T @ su / len(unl) - prior * (pos.T @ sp) / len(pos)  # estimated loss of negatives
        softplus = lambda s: -np.log(np.maximum(1 - s, 1e-13))
        risk = softplus(su).mean() - prior * softplus(sp).mean()
        if risk < 0:
            return -g_neg + decay * w  # step back until the estimate is a possible risk
        return prior * g_pos + g_neg + decay * w

    w = _adam(grad, pos.shape[1], steps, rate)
    return Model(mean, scale, w[:-1], float(w[-1]), prior)


def _feature_rows(texts: DataFrame) -> np.ndarray:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        for batch in batches:
            for part in small_batches(batch, "text"):
                x = features(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("h"), pa.array([r.tobytes() for r in x], pa.binary())], names=["h", "x"])

    got = texts.mapInArrow(rows, "h long, x binary").orderBy("h", "x").collect()  # bounded by the sample sizes
    return np.frombuffer(b"".join(r.x for r in got), np.float32).reshape(-1, DIM)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model | None:
    """Fit on the training folds' trusted positives and on unlabelled texts of the training folds."""
    known = F.col(key).isNotNull() & ~held_out(key)
    trusted = labels.filter((F.col(label) == 1) & known).select(F.col(key).alias("_k")).distinct()
    web = docs.filter(known).select(F.col(key).alias("_k")).distinct()
    texts = docs.select(F.col(key).alias("_k"), F.col(text).alias("text"))
    sample = lambda ids, n, seed: _feature_rows(
        texts.join(hashed_sample(ids, "_k", n, seed), "_k")
        .groupBy(F.col("_h").alias("h")).agg(F.min("text").alias("text")))
    return fit(sample(trusted, positives, SEED), sample(web, unlabelled, SEED + 1))


def score(docs: DataFrame, model: Model | None, text: str = "text", column: str = "score") -> DataFrame:
    """All columns of ``docs`` plus ``column``, the model's score of the whole text."""
    if model is None:
        return docs.withColumn(column, F.lit(0.5))

    names = [c for c in docs.columns if c != column]
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField(column, T.DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        for batch in batches:
            for part in small_batches(batch, text):
                values = model.score(features(part.column(text)).astype(np.float64))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values)], names=[*names, column])

    return docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(scored, schema)


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """Train on ``labels`` and score all of ``docs``: columns of ``docs`` plus held_out, score and predicted."""
    model = train(docs, labels, key, text)
    return (score(docs, model, text).withColumn("held_out", held_out(key))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
