"""Operator 6, token counts: exact length histogram.

Documents are counted by encoded length (combined per batch before the only shuffle of any size,
so it carries at most one row per task and length). Suffix sums over the histogram then answer
every context limit exactly. The sums are taken in two levels, within blocks of lengths and over
the blocks' totals, so no task holds the whole histogram.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from actiontally.llm.common import slices, stored
from actiontally.llm.tokens import encoder

BLOCK = 1024


def length_histogram(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """``length, n_docs`` over all documents; null or empty text has length 0. Repeated rows count
    each time; no rows give an empty histogram."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, seen = encoder(vocabulary), {}
        for _, texts in slices(batches, "text"):
            for p in enc.payloads(texts):
                seen[len(p) // 4] = seen.get(len(p) // 4, 0) + 1
            if len(seen) > 100_000:
                yield _rows(seen)
                seen = {}
        if seen:
            yield _rows(seen)

    def _rows(seen: dict[int, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(seen), type=pa.int64()), pa.array(list(seen.values()), type=pa.int64())], names=["length", "n"])

    return (docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "length bigint, n bigint")
            .groupBy("length").agg(F.sum("n").alias("n_docs")))


def suffix_sums(hist: DataFrame, block: int = BLOCK) -> DataFrame:
    """For each length L that occurs: ``n_docs, n_tokens`` of that length; ``docs_longer,
    tokens_longer`` of greater lengths; ``docs_upto, tokens_upto``; ``tokens_truncated``: all
    tokens left when every document is cut to L ids; ``cum_share``: share of documents up to L."""
    hist = stored(hist.select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("n_tokens"),
                              F.floor(F.col("length") / block).alias("b")), "length-histogram")
    after = Window.orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = hist.groupBy("b").agg(F.sum("n_docs").alias("bd"), F.sum("n_tokens").alias("bt")).select(
        "b", F.coalesce(F.sum("bd").over(after), F.lit(0)).alias("bd_after"), F.coalesce(F.sum("bt").over(after), F.lit(0)).alias("bt_after"),
        F.sum("bd").over(whole).alias("all_docs"), F.sum("bt").over(whole).alias("all_tokens"))
    inside = Window.partitionBy("b").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    longer = lambda c, rest: (F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(rest)).cast("bigint")
    return hist.join(blocks, "b").select(
        "length", "n_docs", "n_tokens", longer("n_docs", "bd_after").alias("docs_longer"),
        longer("n_tokens", "bt_after").alias("tokens_longer"), "all_docs", "all_tokens").select(
        "length", "n_docs", "n_tokens", "docs_longer", "tokens_longer",
        (F.col("all_docs") - F.col("docs_longer")).alias("docs_upto"), (F.col("all_tokens") - F.col("tokens_longer")).alias("tokens_upto"),
        (F.col("all_tokens") - F.col("tokens_longer") + F.col("length") * F.col("docs_longer")).alias("tokens_truncated"),
        ((F.col("all_docs") - F.col("docs_longer")) / F.col("all_docs")).alias("cum_share"))


def truncated_totals(sums: DataFrame, limits: Sequence[int]) -> dict[int, int]:
    """Tokens kept at each context limit: those of documents up to it, plus the limit for each
    longer one. One filtered row per limit reaches the driver."""
    out = {}
    for limit in limits:
        r = sums.filter(F.col("length") <= limit).agg(F.max(F.struct("length", "tokens_upto", "docs_longer")).alias("r")).first()["r"]
        if r is None:  # every document is longer, or there is none
            n = sums.agg(F.max(F.col("docs_longer") + F.col("n_docs")).alias("n")).first()["n"] or 0
            out[limit] = int(n * limit)
        else:
            out[limit] = int(r["tokens_upto"] + limit * r["docs_longer"])
    return out


def quantile(sums: DataFrame, q: float) -> int | None:
    """The least length that at least the share ``q`` of documents does not exceed."""
    r = sums.filter(F.col("cum_share") >= np.float64(q).item()).agg(F.min("length").alias("m")).first()["m"]
    return None if r is None else int(r)
