"""Operator 4, language identification: averaged hashed subword embeddings, linear softmax.

A text's features are the hashed 2- to 4-byte n-grams of its words (letters only, with word
edges). Their embeddings are averaged and a linear softmax gives the language; both are trained by
stochastic gradient descent in numpy on a bounded sample of labelled rows, whose features are
computed on Spark. Since the average is linear, each bucket's embedding times the output weights
is one row of a small table, and a prediction sums table rows over the whole text.

Probabilities are calibrated by a temperature, and the least confidence worth accepting is set on
a part of the sample that training doesn't see.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actiontally.llm.common import class_sample, score_texts, segment_sums, small_side

BUCKET_BITS, DIMENSIONS = 14, 16
#: Labelled rows used per language: the bound of the training sample.
QUOTA = 800
EPOCHS, BATCH, RATE = 12, 32, 30.0
#: Share of accepted predictions that should be right; sets the rejection threshold.
ACCEPTED_RIGHT = 0.99
_UNIT = 1 << 16
_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def has_letter(text: bytes | None) -> bool:
    return bool(text) and any(map(str.isalpha, text.decode("utf-8", "replace")))


def subwords(texts: list[bytes | None], bits: int = BUCKET_BITS) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """For each n-gram length: the bucket of the n-gram that begins at each byte and whether it
    lies in one word; and where each text begins and ends."""
    sizes = np.fromiter((1 + len(t or b"") for t in texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(itertools.chain.from_iterable((b" ", (t or b"").translate(_LETTERS)) for t in texts)) + b"    ", dtype=np.uint8)
    n, gap = int(ends[-1]) if len(ends) else 0, data == 32
    h, out = data[:n].astype(np.uint32), []
    for k in (2, 3, 4):
        h = h * np.uint32(257) + data[k - 1 : n + k - 1]
        inside = ~(gap[:n] & gap[1 : n + 1]) if k == 2 else ~gap[1 : n + 1] if k == 3 else ~(gap[1 : n + 1] | gap[2 : n + 2])
        out.append((((h + np.uint32(k)) * np.uint32(0x9E3779B1) >> np.uint32(32 - bits)).astype(np.int64), inside))
    return out, ends - sizes, ends


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # buckets x languages, fixed point
    bias: np.ndarray
    temperature: float
    least: float

    def logits(self, texts: list[bytes | None]) -> np.ndarray:
        grams, starts, ends = subwords(texts, int(len(self.table)).bit_length() - 1)
        sums, n = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        for bucket, inside in grams:
            n += segment_sums(inside, starts, ends)
            for lang in range(len(self.languages)):
                sums[:, lang] += segment_sums(self.table[bucket, lang] * inside, starts, ends)
        return sums / _UNIT / np.maximum(n, 1)[:, None] + self.bias

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Best language, its calibrated probability, and whether it is to be rejected."""
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        p = softmax(self.logits(texts) / self.temperature)
        known = np.fromiter(map(has_letter, texts), dtype=bool, count=len(texts))
        score = np.where(known, p.max(axis=1), 0.0)
        best = [self.languages[i] if k else "und" for i, k in zip(p.argmax(axis=1).tolist(), known.tolist())]
        return best, score, ~known | (score < self.least)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, bits: int = BUCKET_BITS,
          dim: int = DIMENSIONS, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket table (before rounding) and bias, from (buckets, shares) of each text."""
    rng = np.random.default_rng(7)
    emb, out, bias = rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim)), rng.normal(0, 0.1, (dim, classes)), np.zeros(classes)
    weight = len(labels) / classes / np.maximum(np.bincount(labels, minlength=classes), 1)
    steps, done = epochs * -(-len(rows) // BATCH), 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for a in range(0, len(order), BATCH):
            some = order[a : a + BATCH]
            idx, val = np.concatenate([rows[i][0] for i in some]), np.concatenate([rows[i][1] for i in some])
            n = np.array([len(rows[i][0]) for i in some])
            doc = np.repeat(np.arange(len(some)), n)
            cut = np.cumsum(n) - n
            mean = np.add.reduceat(emb[idx] * val[:, None], cut, axis=0)
            g = softmax(mean @ out + bias)
            g[np.arange(len(some)), labels[some]] -= 1
            g *= weight[labels[some]][:, None] / len(some)
            back, rate = g @ out.T, RATE * (1 - done / steps)
            out -= 0.1 * rate * (mean.T @ g)
            bias -= 0.01 * rate * g.sum(axis=0)
            for k in range(dim):
                emb[:, k] -= rate * np.bincount(idx, weights=val * back[doc, k], minlength=len(emb))
            done += 1
    return emb @ out, bias


def calibrate(logits: np.ndarray, labels: np.ndarray, right: float = ACCEPTED_RIGHT) -> tuple[float, float]:
    """The temperature of least log loss, and the least confidence such that, of the predictions at
    least as confident, the share ``right`` is right."""
    if not len(labels):
        return 1.0, 0.0
    rows = np.arange(len(labels))
    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(np.maximum(softmax(logits / t)[rows, labels], 1e-12)).mean() + 1e-3 * abs(np.log(t)) for t in grid]
    t = float(grid[int(np.argmin(loss))])
    p = softmax(logits / t)
    conf, ok = p.max(axis=1), p.argmax(axis=1) == labels
    order = np.argsort(-conf, kind="stable")
    good = np.cumsum(ok[order]) / np.arange(1, len(order) + 1) >= right
    return t, float(conf[order][np.flatnonzero(good)[-1]]) if good.any() and not good[-1] else 0.0


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quota: int = QUOTA) -> Model:
    """A model from the rows where ``learn`` holds and the language isn't null: at most about
    ``quota`` of each language, chosen by a hash of the id. A text without letters teaches nothing; an
    id given with two languages teaches each from its own row.
    Without usable rows the model knows no language."""
    rows = docs.filter(learn & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("key"), F.col(lang_col).alias("lang")).distinct()
    chosen = class_sample(rows, "key", "lang", quota)
    picked = small_side(chosen.select(F.col("key").alias("chosen"), "lang"))
    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("own")).join(
        picked, (F.col("key") == F.col("chosen")) & (F.col("own") == F.col("lang"))).select("key", "lang", "text")

    def make():  # noqa: ANN202
        def f(texts: list[bytes | None]) -> list[pa.Array]:
            grams, starts, ends = subwords(texts)
            idx, val = [], []
            for a, b, t in zip(starts.tolist(), ends.tolist(), texts):
                u, n = np.unique(np.concatenate([h[a:b][m[a:b]] for h, m in grams]), return_counts=True)
                if not has_letter(t):
                    u, n = u[:0], n[:0]
                idx.append(u.astype("<i4").tobytes())
                val.append((n / max(1, n.sum())).astype("<f4").tobytes())
            return [pa.array(idx, type=pa.binary()), pa.array(val, type=pa.binary())]
        return f

    got = score_texts(texts, "text", "idx binary, val binary", make, keep=["key", "lang"]).toArrow().to_pylist()  # the bounded sample
    got = sorted((r for r in got if r["idx"]), key=lambda r: (str(r["key"]), r["idx"]))
    langs = sorted({r["lang"] for r in got})
    if not langs:
        return Model([], np.zeros((1 << BUCKET_BITS, 0), dtype=np.int64), np.zeros(0), 1.0, 1.0)
    x = [(np.frombuffer(r["idx"], dtype="<i4"), np.frombuffer(r["val"], dtype="<f4").astype(np.float64)) for r in got]
    y = np.array([langs.index(r["lang"]) for r in got])
    aside = np.arange(len(y)) % 5 == 4
    table, bias = train([x[i] for i in np.flatnonzero(~aside)], y[~aside], len(langs))
    model = Model(langs, np.rint(table * _UNIT).astype(np.int64), bias, 1.0, 0.0)
    held = np.array([(table[i] * v[:, None]).sum(axis=0) + bias for i, v in (x[j] for j in np.flatnonzero(aside))]).reshape(-1, len(langs))
    model.temperature, model.least = calibrate(held, y[aside])
    return model


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all, if None) with ``lang_pred``, its probability ``score``, and
    ``rejected``: not confident enough to be relied on. Null text and text without a letter: ``und``,
    score 0, rejected. Repeated rows get the same answer; no rows, none."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():  # noqa: ANN202
        def f(texts: list[bytes | None]) -> list[pa.Array]:
            best, score, rejected = sent.value.predict(texts)
            return [pa.array(best, type=pa.string()), pa.array(score, type=pa.float64()), pa.array(rejected)]
        return f

    return score_texts(docs, text_col, "lang_pred string, score double, rejected boolean", make, keep)
