"""Quality classifier by positive-unlabelled learning.

A small network over features of the text's shape is fitted by the non-negative
unbiased risk: with class prior p, positives' loss p * R(P, +1) plus the
unlabelled texts' loss as negatives less what the positives among them add,
R(U, -1) - p * R(P, -1), held at zero or above; where it falls below, its
gradient is turned. Trusted positives are texts labelled good, unlabelled ones
are all texts outside the held-out fold. The prior is estimated from these two alone, by
the best bin: a network that tells positives from unlabelled texts is fitted on one half,
and on the other the least share of unlabelled to positive texts above a score, by its
upper confidence bound, is the share of good ones among the unlabelled. Labels that
say bad are never used. The logistic loss makes the output a probability.

The fit sees at most ``most`` positive and ``most`` unlabelled rows, those of the least
hashes, whatever the input; all rows are scored.

Edge cases: null, empty and blank texts have the features of an empty text;
labels that repeat or contradict each other are averaged (good from one half
up), null labels are ignored; a null id is never held out nor labelled; with no
positive to learn from every score is 1; repeated rows are each scored; other
columns are never read.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST, THRESHOLD, HIDDEN, STEPS, BATCH, RATE = 20_000, 0.7, 24, 1500, 1024, 0.01
PRIOR_STEPS, SPLITS, FOLDS, HELD_OUT = 400, 5, 4, 2
_CLASSES = [b"\n", b"0123456789", b"!", b".,;:'\"-()", b"|", b"#$%&*", b"/\\<>={}[]_~^`+@", b"?", bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(128, 256))]
_CLASS_OF = np.full(256, len(_CLASSES))
for _i, _c in enumerate(_CLASSES):
    _CLASS_OF[list(_c)] = _i
N_FEATURES = len(_CLASSES) + 11


def features(text: str | None) -> np.ndarray:
    """Shares and logarithms that tell the shape of a text, not its words."""
    text = text or ""
    data, words = text.encode("utf-8", "replace"), text.split()
    n, m = max(1, len(data)), max(1, len(words))
    shares = np.bincount(_CLASS_OF, np.bincount(np.frombuffer(data, np.uint8), minlength=256), len(_CLASSES) + 1)[:-1] / n
    distinct = len(set(words))
    shape = [
        sum(map(str.isupper, words)) / m,
        sum(map(str.istitle, words)) / m,
        sum(map(str.isalpha, words)) / m,
        sum(map(str.isalnum, words)) / m,
        sum(map(operator.eq, words, words[1:])) / m,
        distinct / m,
        np.log1p(distinct) / np.log1p(m),
        np.log1p(len(words)) / 10,
        np.log1p(len(data)) / 10,
        len(text) / m / 10,
        max(map(len, words), default=0) / 100,
    ]
    return np.concatenate([np.log(1e-3 + shares), np.minimum(shape, 5.0)])


@dataclass
class Model:
    """A network of one hidden layer over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    prior: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.tanh((x - self.mean) / self.scale @ a + b) @ c + d

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS, seed: int = 0, unbiased: bool = True) -> Model:
    """Minimise the non-negative unbiased risk by Adam over mini-batches.

    Without ``unbiased`` unlabelled texts count as negatives as they are.
    """
    rng = np.random.default_rng(seed)
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-6
    p_all, u_all = (positive - mean) / scale, (unlabelled - mean) / scale
    w = [rng.normal(0, both.shape[1] ** -0.5, (both.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for t in range(1, steps + 1):
        p, u = p_all[rng.integers(0, len(p_all), BATCH)], u_all[rng.integers(0, len(u_all), BATCH)]
        x = np.concatenate([p, u])
        h = np.tanh(x @ w[0] + w[1])
        z = h @ w[2] + w[3]
        zp, zu = z[: len(p)], z[len(p) :]
        taken = prior * unbiased  # the share that positives among the unlabelled are taken to have
        rest = np.logaddexp(0, zu).mean() - taken * np.logaddexp(0, zp).mean()
        # gradients of the losses log(1 + exp(-z)) and log(1 + exp(z)) by z
        gp, gu = np.zeros(len(p)), np.zeros(len(u))
        if rest >= 0:
            gp += prior * (sigmoid(zp) - 1) / len(p) - taken * sigmoid(zp) / len(p)
            gu += sigmoid(zu) / len(u)
        else:  # only the part below zero, upwards
            gp += taken * sigmoid(zp) / len(p)
            gu -= sigmoid(zu) / len(u)
        gz = np.concatenate([gp, gu])
        back = gz[:, None] * w[2] * (1 - h * h)
        grads = [x.T @ back, back.sum(axis=0), h.T @ gz, np.array([gz.sum()])]
        rate = RATE * min(1.0, 3 * (1 - t / (steps + 1)))
        for k, g in enumerate(grads):
            g = g + 1e-4 * w[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            w[k] = w[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return Model(mean, scale, w, prior)


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, steps: int = PRIOR_STEPS, delta: float = 0.1, splits: int = SPLITS) -> float:
    """The share of positives among the unlabelled, by the best bin: the mean over random halves and one deviation more.

    A prior that is too high only keeps more; the deviation vanishes as the samples grow.
    """
    if len(positive) < 4 or len(unlabelled) < 4:
        return 0.5
    found = []
    for seed in range(splits):
        rng = np.random.default_rng(seed + 1)
        p, u = rng.permutation(positive), rng.permutation(unlabelled)
        model = fit(p[::2], u[::2], 0.5, steps, unbiased=False)
        zp, zu = np.sort(model.logit(p[1::2])), np.sort(model.logit(u[1::2]))
        cuts = np.unique(zp)
        share, held = (1 - np.searchsorted(z, cuts) / len(z) for z in (zu, zp))
        wide = 1.01 * (math.sqrt(math.log(4 / delta) / (2 * len(zu))) + math.sqrt(math.log(4 / delta) / (2 * len(zp))))
        best = int(np.argmin((share + wide) / held))
        found.append(share[best] / held[best])
    return float(np.clip(np.mean(found) + np.std(found), 0.01, 0.99))


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def _features_of(docs: DataFrame, text_col: str, most: int) -> np.ndarray:
    """Features of at most ``most`` rows, on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([features(x.as_py()).tobytes() for x in b.column(0)], pa.binary())], names=["f"])

    found = docs.select(text_col).mapInArrow(run, "f binary")
    rows = found.orderBy(F.xxhash64("f"), "f").limit(most).toArrow()["f"].to_pylist()  # of rows that repeat an id too
    return np.frombuffer(b"".join(sorted(rows)), float).reshape(-1, N_FEATURES)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = MOST) -> Model | None:
    """A model from the labels outside the held-out fold; None if none is positive."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).groupBy(F.col(id_col).alias("_l")).agg((F.avg(label_col) >= 0.5).alias("good"))
    good = known.where("good").select(F.col("_l").alias("_id"))
    if good.isEmpty():
        return None
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(~held_out(F.col("_id")))

    def sample(ids: DataFrame) -> np.ndarray:
        # of many ids only some twice as many as wanted, by a bound on the hash, are sorted
        n, place = ids.count(), F.pmod(F.xxhash64("_id"), F.lit(1 << 31))
        few = ids.where(place < F.lit(max(1, (2 * most << 31) // max(n, 1))))
        if n <= 4 * most or few.count() < most:
            few = ids
        least = few.orderBy(place, "_id").limit(most).select(F.col("_id").alias("_s")).distinct()  # at most ``most`` ids
        return _features_of(texts.join(F.broadcast(least), F.col("_id") == F.col("_s"), "left_semi"), "_text", most)

    positive, unlabelled = sample(good), sample(texts.select("_id"))
    if not len(positive) or not len(unlabelled):
        return None
    return fit(positive, unlabelled, class_prior(positive, unlabelled))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(id, held_out, score, predicted)`` of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.ones(len(b)) if model is None or not len(b) else model.score(np.array([features(x.as_py()) for x in b.column(1)]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.float64())], names=["_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, f"_id {kind}, score double")
    return found.select(F.col("_id").alias(id_col), held_out(F.col("_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model | None, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that the model rejects."""

    @F.pandas_udf("boolean")
    def good(texts):
        if model is None or not len(texts):
            return texts.map(lambda _: True).astype(bool)
        return pd.Series(model.score(np.array([features(t) for t in texts])) >= threshold)

    return docs.where(good(F.col(text_col)))
