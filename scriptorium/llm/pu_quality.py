"""Quality classifier by positive-unlabelled learning.

Trusted positives (label 1) and unlabelled web text are all that is learnt from.  A first linear model tells
positives from unlabelled text; the class prior is estimated from its scores, as the least ratio of the shares
of unlabelled and of positive texts above a threshold.  The second model minimises the non-negative unbiased risk

    prior * E_p[l(+)] + max(0, E_u[l(-)] - prior * E_p[l(-)])

with the logistic loss; when the second part falls below zero, its gradient is followed upwards.

A text's features are square roots of the shares of its bytes and of pairs of byte classes, and a few ratios
of its words and lines; they are computed from the whole text.  The fit uses at most about SAMPLE positives and SAMPLE
unlabelled texts (both bounds are of the fit alone), picked by a hash of their ids, and only feature vectors reach the driver; scoring is one pass
over the table without a shuffle.

Defined results: a null text is the empty text and gets a score like any other; without positives every score
is 0.5; a doc_id with several labels is a positive if one of them is; rows that repeat an id are scored each; equal texts have equal
scores; very long texts are read whole; an empty table gives an empty result; other columns pass through accepted, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts of each kind that the model is fitted on, at most.
SAMPLE = 4000
STEPS = 200
_CLASSES = 16


def _byte_classes() -> np.ndarray:
    out = np.full(256, 15, np.uint8)
    for k, chars in enumerate((b" ", b"\n\r", b"\t\v\f", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:", b"!?", b"'\"`", b"()[]{}<>", b"|/\\", b"#$%&*@^~", b"-_=+")):
        out[list(chars)] = k
    out[128:192] = 13  # continuation bytes
    out[192:] = 14
    return out


_CLASS = _byte_classes()
N_FEATURES = 256 + _CLASSES**2 + 6


def features(text: str) -> np.ndarray:
    raw = text.encode()
    out = np.zeros(N_FEATURES, np.float32)
    if not raw:
        return out
    b = np.frombuffer(raw, np.uint8)
    out[:256] = np.bincount(b, minlength=256)
    c = _CLASS[b]
    out[256 : 256 + _CLASSES**2] = np.bincount(c[:-1] * np.uint8(_CLASSES) + c[1:], minlength=256)
    out[:-6] = np.sqrt(out[:-6] / len(b))
    words, lines = raw.split(), raw.split(b"\n")
    out[-6] = np.log1p(len(b)) / 10
    if words:
        out[-5] = len(set(words)) / len(words)
        out[-4] = min(4.0, len(b) / len(words) / 8)
        out[-3] = min(4.0, len(words) / len(lines) / 50)
    out[-2] = len(set(lines)) / len(lines)
    out[-1] = np.log1p(len(lines)) / 10
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class _Adam:
    def __init__(self, n: int, rate: float) -> None:
        self.m, self.v, self.t, self.rate = np.zeros(n, np.float32), np.zeros(n, np.float32), 0, rate

    def step(self, g: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * g
        self.v = 0.999 * self.v + 0.001 * g * g
        return self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def _fit(p: np.ndarray, u: np.ndarray, prior: float | None, steps: int, l2: float = 1e-3) -> np.ndarray:
    """Weights, the last one the intercept; without a prior, of positives against unlabelled texts."""
    w = np.zeros(p.shape[1], np.float32)
    adam = _Adam(len(w), 0.05)
    for _ in range(steps):
        fp, fu = _sigmoid(p @ w), _sigmoid(u @ w)
        up, down_u, down_p = p.T @ (fp - 1) / len(p), u.T @ fu / len(u), p.T @ fp / len(p)
        if prior is None:
            g = up + down_u
        else:
            negative = -np.mean(np.log(1 - fu + 1e-9)) + prior * np.mean(np.log(1 - fp + 1e-9))
            part = down_u - prior * down_p
            g = prior * up + part if negative >= 0 else -part
        g[:-1] += l2 * w[:-1]
        w -= adam.step(g)
    return w


def class_prior(p: np.ndarray, u: np.ndarray) -> float:
    """From scores: the least ratio of shares above a threshold, with a margin for few texts.

    A positive text has a share of at least so much among unlabelled ones; the ratio is that share where no
    negative text is above the threshold."""
    cuts = np.quantile(p, np.linspace(0.02, 0.7, 69))
    above_p = np.array([np.mean(p >= c) for c in cuts])
    above_u = np.array([np.mean(u >= c) for c in cuts])
    margin = np.sqrt(np.log(100) / 2 / len(u)) + np.sqrt(np.log(100) / 2 / len(p))
    at = np.argmin((above_u + margin) / np.maximum(above_p, 1e-9))
    return float(np.clip(above_u[at] / max(above_p[at], 1e-9), 0.05, 0.98))


class Model:
    """A standardised linear model; a plain object that is sent to executors."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, prior: float) -> None:
        self.mean, self.scale, self.weights, self.prior = mean, scale, weights, prior

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid((self.expand(x) @ self.weights).astype(np.float64))

    def expand(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([np.clip((x - self.mean) / self.scale, -8, 8), np.ones((len(x), 1))]).astype(np.float32)


def train(p: np.ndarray, u: np.ndarray, steps: int = STEPS) -> Model:
    if not len(p) or not len(u):
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES + 1), 0.5)
    model = Model(u.mean(0), u.std(0) + 1e-3, np.zeros(N_FEATURES + 1), 0.5)
    xp, xu = model.expand(p), model.expand(u)
    first = _fit(xp, xu, None, steps)
    model.prior = class_prior(xp @ first, xu @ first)
    model.weights = _fit(xp, xu, model.prior, steps)
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _sampled(ids: DataFrame, n: int, most: int) -> DataFrame:
    """About most of n ids, by a hash."""
    share = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(11)), 11).cast("double") / float(1 << 53)
    return ids.where(share < min(1.0, most / max(1, n)))


def _vectors(rows: DataFrame) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([features(t or "").tobytes() for t in b.column(1).to_pylist()], pa.binary())], ["place", "x"])

    placed = rows.select(F.xxhash64("doc_id", "text").alias("place"), "text").mapInArrow(run, "place long, x binary")
    # at most 2 * SAMPLE vectors of 2 KB, the same in every run
    found = placed.orderBy("place", "x").limit(2 * SAMPLE).collect()
    return np.array([np.frombuffer(r["x"], np.float32) for r in found]).reshape(-1, N_FEATURES)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """From labels (doc_id, quality) that are not held out, and unlabelled texts."""
    good = labels.where((F.col("quality") == 1) & ~held_out(F.col("doc_id"))).select("doc_id").distinct()
    picked = F.broadcast(_sampled(good, good.count(), SAMPLE))  # about SAMPLE ids
    free = docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text")
    positives = _vectors(free.join(picked, "doc_id", "left_semi"))
    unlabelled = _vectors(_sampled(free, free.select("doc_id").count(), SAMPLE))
    return train(positives, unlabelled)


def scored(docs: DataFrame, model: Model, columns: list[str], out: str = "score") -> DataFrame:
    """Some columns of docs and the score of text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema[c] for c in columns] + [T.StructField(out, T.DoubleType())])
    named = docs.select(*[F.col(f"`{c}`") for c in columns], F.col("text").alias("__pu_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            texts = b.column(len(columns))
            parts = [m.scores(np.array([features(t.as_py() or "") for t in texts.slice(a, 512)])) for a in range(0, len(texts), 512)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(columns))), pa.array(np.concatenate(parts) if parts else [], pa.float64())], [*columns, out])

    return named.mapInArrow(run, schema)


CUT = 0.3


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    rows = scored(docs, fit(docs, labels), ["doc_id"])
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier doesn't reject, with the columns of docs."""
    return scored(docs, fit(docs, labels), docs.columns, "__pu_score").where(F.col("__pu_score") >= CUT).drop("__pu_score")
