"""Operator 8, quality classifier: positive-unlabelled learning.

Trusted positives and unlabelled web text train a linear model by minimising the non-negative
unbiased risk, pi E_p[l(g)] + max(0, E_u[l(-g)] - pi E_p[l(-g)]), with the class prior pi estimated
from how the two samples' scores compare. Its scores are turned into probabilities on the labelled
rows. Samples are bounded and their features computed on Spark; scoring reads every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actiontally.llm.common import class_sample, id_mod, joined_bytes, score_texts, small_side
from actiontally.llm.quality_rules import GRAM, gram_buckets, text_counts

BUCKET_BITS = 11
#: Bounds of the samples: trusted positives, unlabelled rows, and negatives that calibrate scores.
POSITIVES, UNLABELLED, NEGATIVES = 2000, 3000, 1500
STEPS, RATE, DECAY = 300, 0.05, 1e-4
PLAIN = 9
SCORE_CUT = 0.3
_UPPER, _DIGITS = bytes(range(0x41, 0x5B)), bytes(range(0x30, 0x3A))


def features(texts: list[bytes | None]) -> np.ndarray:
    """Per text: square roots of the shares of hashed byte n-grams, then plain measures."""
    size, m = 1 << BUCKET_BITS, len(texts)
    data, starts, ends = joined_bytes(texts)
    last = np.maximum(starts, ends - GRAM + 1)
    of = np.repeat(np.arange(m), ends - starts)
    inside = np.arange(len(data)) < last[of] if len(data) else np.zeros(0, dtype=bool)
    counts = np.bincount((of * size + gram_buckets(data, BUCKET_BITS))[inside], minlength=m * size).reshape(m, size)
    x = np.zeros((m, size + PLAIN), dtype=np.float32)
    x[:, :size] = np.sqrt(counts / np.maximum(1, last - starts)[:, None])
    c = text_counts(texts)
    full = [t or b"" for t in texts]
    without = lambda drop: np.array([len(t) - len(t.translate(None, drop)) for t in full], dtype=np.float64)
    chars, words = np.maximum(1, ends - starts), np.maximum(1, c["n_words"])
    lines = np.array([t.count(b"\n") + 1 for t in full])
    split = [t.split() for t in full]
    again = np.array([sum(map(bytes.__eq__, s, s[1:])) for s in split])
    distinct = np.array([len(set(s)) for s in split])
    x[:, size:] = np.stack([np.log1p(c["n_words"]) / 10, c["n_symbols"] / chars * 5, without(_UPPER) / chars * 2, without(_DIGITS) / chars * 5,
                            c["n_dup_lines"] / lines, c["n_repeat_words"] / words, again / words, distinct / words, c["word_chars"] / words / 10], axis=1)
    return x


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    prior: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(np.float64) * self.weights).sum(axis=1) + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.raw(x) + self.shift)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def descend(x: np.ndarray, gradient, steps: int = STEPS, rate: float = RATE) -> tuple[np.ndarray, float]:  # noqa: ANN001
    """Adam on linear scores; ``gradient(g)`` is the risk's gradient by each row's score."""
    w, b = np.zeros(x.shape[1]), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        by_row = gradient(x @ w.astype(np.float32) + b)
        d = np.append(x.T @ by_row.astype(np.float32) + DECAY * w, by_row.sum())
        m, v = 0.9 * m + 0.1 * d, 0.999 * v + 0.001 * d * d
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def class_prior(pos: np.ndarray, unl: np.ndarray, slack: float = 1.0) -> float:
    """Least ratio, over score cuts, of the unlabelled share above the cut to the positives' share
    (each with its sampling error): the share of positives that the unlabelled sample can hold."""
    cuts = np.quantile(pos, np.linspace(0.02, 0.9, 60))
    above = lambda s: (s[None, :] >= cuts[:, None]).mean(axis=1)
    err = slack * np.sqrt(1 / len(unl)), slack * np.sqrt(1 / len(pos))
    return float(np.clip(np.min((above(unl) + err[0]) / np.maximum(above(pos) - err[1], 1e-3)), 0.05, 0.95))


def nonnegative_risk(x: np.ndarray, pos: np.ndarray, unl: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights of least non-negative risk with the logistic loss; a step during which the negative
    part is below zero climbs it back instead."""
    n_p, n_u = max(1, pos.sum()), max(1, unl.sum())

    def gradient(g: np.ndarray) -> np.ndarray:
        up = sigmoid(g)  # derivative of l(-g); that of l(g) is up - 1
        negative = np.logaddexp(0, g) @ (unl / n_u - prior * pos / n_p)
        part = up * (unl / n_u - prior * pos / n_p)
        return -part if negative < 0 else prior * (up - 1) * pos / n_p + part

    return descend(x, gradient)


def platt(g: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and shift of the logistic curve through labelled scores (Newton steps, softened targets)."""
    n1, n0 = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    z = np.stack([g, np.ones_like(g)], axis=1)
    c = np.array([1.0, 0.0])
    for _ in range(steps):
        p = sigmoid(z @ c)
        h = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, z.T @ (weight * (p - target)))
        c = c - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return (float(c[0]), float(c[1])) if c[0] > 0 else (1.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame, learn_mod: int = 5, held: int = 0, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> Model:
    """A model from the labels of ids whose crc32 modulo ``learn_mod`` isn't ``held``. Other labels
    are never looked at. Null ids and labels teach nothing; an id with both labels is a positive and a
    negative; without positives every score is 1/2.

    The ranking comes from positives and unlabelled rows alone. Labelled negatives set only the logistic
    curve's slope and shift, which turn a rank into a probability; without them it is the plain curve."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & (id_mod(id_col, learn_mod) != held)).select(
        F.col(id_col).alias("key"), F.col(label_col).cast("int").alias("y")).distinct()
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    pos = class_sample(known.filter("y = 1"), "key", "y", POSITIVES)
    neg = class_sample(known.filter("y = 0"), "key", "y", NEGATIVES)
    any_ = class_sample(docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("key"), F.lit(2).alias("y")), "key", "y", UNLABELLED)
    picked = small_side(pos.union(neg).union(any_).groupBy(F.col("key").alias("chosen")).agg(
        *(F.max((F.col("y") == i).cast("int")).alias(n) for i, n in enumerate(("neg", "pos", "unl")))))
    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text")).join(picked, F.col("key") == F.col("chosen"))

    def make():  # noqa: ANN202
        return lambda texts: [pa.array([r.astype("<f2").tobytes() for r in features(texts)], type=pa.binary())]

    got = score_texts(texts, "text", "x binary", make, keep=["key", "neg", "pos", "unl"]).toArrow()  # the bounded sample
    n = 1 << BUCKET_BITS
    if not got.num_rows or not sizes.get(1):
        return Model(np.zeros(n + PLAIN), 0.0, 1.0, 0.0, 0.5)
    order = np.argsort(np.array([str(k) for k in got["key"].to_pylist()]), kind="stable")
    x = np.frombuffer(b"".join(got["x"].to_pylist()), dtype="<f2").reshape(got.num_rows, -1)[order].astype(np.float32)
    is_neg, is_pos, is_unl = (got[c].to_numpy()[order].astype(np.float64) for c in ("neg", "pos", "unl"))
    # First a plain split of positives from unlabelled rows, whose scores give the prior.
    half = is_pos / max(1, is_pos.sum()) + is_unl / max(1, is_unl.sum())
    share = (is_pos / max(1, is_pos.sum())) / np.maximum(half, 1e-12)
    w, b = descend(x, lambda g: (sigmoid(g) - share) * half / 2, steps=100)
    first = x @ w.astype(np.float32) + b
    prior = class_prior(first[is_pos > 0], first[is_unl > 0]) if is_unl.sum() and is_pos.sum() else 0.5
    w, b = nonnegative_risk(x, is_pos, is_unl, prior)
    model = Model(w, b, 1.0, 0.0, prior)
    both = (is_neg + is_pos) > 0
    if is_neg.any() and is_pos.any():
        y = is_pos[both]
        weight = np.where(y == 1, sizes[1] / is_pos.sum(), sizes[0] / is_neg.sum())
        model.slope, model.shift = platt(model.raw(x[both]), y, weight / weight.mean())
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all, if None) with ``score`` (0 to 1). Null counts as empty text, which
    has a score like any other; repeated rows score alike; no rows give none."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():  # noqa: ANN202
        # In groups of texts, so that the feature matrix stays small; a row's score depends on it alone.
        return lambda texts: [pa.array(np.concatenate([sent.value.score(features(texts[a : a + 256])) for a in range(0, len(texts), 256)]))]

    return score_texts(docs, text_col, "score double", make, keep)
