"""Operator 5, quality rules: log-likelihood ratio of hashed n-grams.

Two multinomials over hashed byte n-grams are counted: one over the trusted documents, one over all
documents. A document's score is the mean over its n-grams of log p(trusted) - log p(raw); it is
kept if it passes the base rules and scores at least the threshold. Both counts cover every
document; what the driver and the tasks hold is the table of buckets, whose size is a parameter.
Ratios are fixed-point integers, so a score does not depend on how rows are batched.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actiontally.llm.common import joined_bytes, score_texts, segment_sums, slices, small_side
from actiontally.session import bound_arrow

GRAM = 3
BUCKET_BITS = 16
#: Mean log ratio (nats per n-gram) from which a document is kept. A document like the raw corpus
#: is near 0 at any corpus size; one whose n-grams trusted documents lack falls below -1.
THRESHOLD = -0.5
#: Added to every bucket's count in both multinomials.
SMOOTHING = 1.0
_UNIT = 1 << 16

MIN_WORDS, MAX_REPEATED = 50, 50
_SPACE = bytes([0x20, *range(0x09, 0x0E)])
_SYMBOLS = b"#*$%&|<>"
_CONTINUED = bytes(range(0x80, 0xC0))


def gram_buckets(data: np.ndarray, bits: int = BUCKET_BITS, n: int = GRAM) -> np.ndarray:
    """Bucket of the n-gram that begins at each byte; the last n - 1 entries are of no use."""
    h = np.zeros(len(data), dtype=np.uint32)
    for i in range(n):
        h[: len(data) - i] = h[: len(data) - i] * np.uint32(257) + data[i:]
    return ((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)).astype(np.int64)


def repeated_words(words: list[list[bytes]]) -> np.ndarray:
    """Per text: words in three-word windows that the text holds twice or more."""
    n = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    number: dict[bytes, int] = defaultdict(itertools.count().__next__)
    ids = np.fromiter(map(number.__getitem__, itertools.chain.from_iterable(words)), dtype=np.int64, count=int(n.sum()))
    if len(ids) < 3:
        return np.zeros(len(words), dtype=np.int64)
    doc = np.repeat(np.arange(len(words)), n)
    inside = np.flatnonzero(doc[2:] == doc[:-2])
    if not len(inside):
        return np.zeros(len(words), dtype=np.int64)
    key, size = ids[inside], len(number)
    for step in (ids[inside + 1], ids[inside + 2], doc[inside]):  # keys are renumbered, so they never overflow
        top = max(size, len(words))
        key = np.unique(key, return_inverse=True)[1] if int(key.max() + 1) * top >= 1 << 62 else key
        key = key * top + step
    _, key, count = np.unique(key, return_inverse=True, return_counts=True)
    at = inside[count[key] > 1]
    hit = np.zeros(len(ids), dtype=bool)
    for i in range(3):
        hit[at + i] = True
    return np.bincount(doc[hit], minlength=len(words))


def text_counts(texts: list[bytes | None]) -> dict[str, np.ndarray]:
    """The base counts of each text; null has none."""
    words = [(t or b"").split() for t in texts]
    full = [t or b"" for t in texts]
    count = lambda it: np.fromiter(it, dtype=np.int64, count=len(texts))

    def repeats(t: bytes) -> int:
        lines = [x for x in t.split(b"\n") if x.strip()] if b"\n" in t else []
        return len(lines) - len(set(lines))

    return {"n_words": count(map(len, words)), "word_chars": count(len(t.translate(None, _SPACE + _CONTINUED)) for t in full),
            "n_symbols": count(len(t) - len(t.translate(None, _SYMBOLS)) for t in full),
            "n_dup_lines": count(map(repeats, full)), "n_repeat_words": repeated_words(words)}


def fit(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        bits: int = BUCKET_BITS, smoothing: float = SMOOTHING) -> np.ndarray:
    """Log ratio of each bucket, in units of 1 / 65536, from all documents; ``trusted`` has the ids
    of the trusted ones (repeated and null ids there are ignored). Without trusted documents every
    ratio is 0. Documents repeated are counted each time; null and empty texts count nothing."""
    bound_arrow(docs.sparkSession)
    size = 1 << bits
    ids = small_side(trusted.select(F.col(trusted.columns[0]).alias("trusted")).filter("trusted is not null").distinct())
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text")).join(
        ids, F.col("key") == F.col("trusted"), "left").select(F.col("trusted").isNotNull().alias("good"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        for batch, texts in slices(batches, "text"):
            data, starts, ends = joined_bytes(texts)
            h = gram_buckets(data, bits)
            use = np.zeros(len(data) + 1, dtype=np.int64)  # +1 where a text's n-grams begin, -1 behind its last
            last = np.maximum(starts, ends - GRAM + 1)
            np.add.at(use, starts, 1)
            np.add.at(use, last, -1)
            of = np.cumsum(use)[:-1] > 0
            raw += np.bincount(h[of], minlength=size)
            mark = np.repeat(batch.column("good").to_numpy(zero_copy_only=False), ends - starts)
            good += np.bincount(h[of & mark], minlength=size)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(good[at])], names=["bucket", "raw", "good"])

    sums = rows.mapInArrow(count, "bucket bigint, raw bigint, good bigint").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("good").alias("good")).toArrow()  # at most a row per bucket
    raw, good = np.zeros(size), np.zeros(size)
    at = sums["bucket"].to_numpy()
    raw[at], good[at] = sums["raw"].to_numpy(), sums["good"].to_numpy()
    if not good.sum():
        return np.zeros(size, dtype=np.int64)
    p = lambda c: np.log((c + smoothing) / (c.sum() + smoothing * size))
    return np.rint((p(good) - p(raw)) * _UNIT).astype(np.int64)


RESULT = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "base_failed boolean, kept boolean, llr double")


def rate(docs: DataFrame, ratios: np.ndarray, text_col: str = "text", threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all, if None) with the base counts, ``base_failed``, ``kept`` and
    ``llr``, the score. Null or empty text fails the base rule for its lack of words; a text shorter
    than an n-gram scores 0. Repeated rows are rated alike; no rows give none."""
    sent, bits = docs.sparkSession.sparkContext.broadcast(ratios), int(len(ratios)).bit_length() - 1

    def make():  # noqa: ANN202
        def f(texts: list[bytes | None]) -> list[pa.Array]:
            c = text_counts(texts)
            failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEATED * c["n_words"])
            data, starts, ends = joined_bytes(texts)
            last = np.maximum(starts, ends - GRAM + 1)
            n = last - starts
            score = segment_sums(sent.value[gram_buckets(data, bits)], starts, last) / np.maximum(n, 1) / _UNIT
            return [*(pa.array(x) for x in c.values()), pa.array(failed), pa.array(~failed & (score >= threshold)), pa.array(score)]
        return f

    return score_texts(docs, text_col, RESULT, make, keep)
