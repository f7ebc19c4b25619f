"""Operator 11, mixing sources to target weights by subset-sum budget fitting.

Documents are counted by source and exact length in words. Sources share a budget by weight, each
up to a multiple of its own size; what a source can't take is shared again. A source takes all its
documents as often as its target holds it whole, and fits what is left of the target: a share
spread evenly over the lengths first, then a bounded knapsack over the lengths still free, whose
table is as long as the longest texts, not as the budget. The plan says how many documents of each length
are taken once more; those with the lowest seeded hash are. Ranks are taken within slices of the hash,
so copies by the million of one length and source meet in no single task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actiontally.llm.common import joined_bytes, segment_sums, slices, small_side, stored

#: Weights of the sources in order, repeating; the mix as a share of all words; the
#: most that a source gives, as a multiple of its words.
WEIGHTS, SHARE, MOST = (3, 1, 2), Fraction(3, 2), 2
SEED = 11
#: Slices of the hash within which documents of one source and length are ranked.
HASH_SLICES = 256
#: Longest knapsack table, in words; a remainder beyond half of it is first filled by the longest texts.
TABLE = 1 << 22
#: Sources of so few words are fitted over all their lengths where the even share leaves a gap.
SMALL = 1 << 18
_BLANK = np.array([c == 0x20 or 0x09 <= c <= 0x0D for c in range(256)])


def word_counts(texts: list[bytes | None]) -> np.ndarray:
    """Number of words (runs of anything but blanks) of each text."""
    data, starts, ends = joined_bytes(texts)
    word = ~_BLANK[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    full = ends > starts
    first[starts[full]] = word[starts[full]]
    return segment_sums(first, starts, ends)


def sized(docs: DataFrame, id_col: str, source_col: str, text_col: str, seed: int) -> DataFrame:
    """``key, source, size, slice, draw`` of each row; ``draw`` is a hash of the seed, id and text,
    ``slice`` its leading bits."""
    rows = docs.select(F.col(id_col).alias("key"), F.col(source_col).cast("string").alias("source"),
                       F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.col(text_col).cast("string")).alias("draw"),
                       F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(word_counts(texts))], names=["key", "source", "draw", "size"])

    out = rows.mapInArrow(run, T.StructType([*rows.schema.fields[:3], T.StructField("size", T.LongType())]))
    return out.withColumn("slice", F.shiftrightunsigned("draw", 64 - HASH_SLICES.bit_length() + 1).cast("int"))


def in_order(sources: DataFrame) -> DataFrame:
    """The sources with ``nth`` from 0 by code point, null last. Sorted by range, counted in each
    range; no task sees all sources."""
    dealt = sources.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    rows = stored(dealt.withColumn("at", F.monotonically_increasing_id()), "mix-sources")
    part = F.shiftright("at", 33)
    counts = sorted(rows.groupBy(part.alias("part")).count().collect())  # one row per partition
    before = dict(zip((p for p, _ in counts), np.cumsum([0, *(n for _, n in counts)]).tolist()))
    start = F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), part) if before else F.lit(0)
    return rows.withColumn("nth", (start + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).cast("bigint")).drop("at")


def with_targets(sources: DataFrame, weights: tuple[int, ...], share: Fraction, most: int) -> DataFrame:
    """Sources (``nth``, ``source_size``) with ``target``: ``share`` of all words dealt by weight, at
    most ``most`` times the source's words each, the excess shared again by weight until no source
    is above. Each round sends the driver three sums."""
    rows = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("nth") % len(weights) + 1).cast("int")))
    total = rows.agg(F.sum(F.col("source_size").cast("decimal(38,0)"))).first()[0] or 0
    budget, rate = share * int(total), None
    while True:
        held = F.lit(False) if rate is None else F.col("source_size").cast("decimal(38,0)") * most * rate.denominator <= F.col("weight") * F.lit(str(rate.numerator)).cast("decimal(38,0)")
        full, free = rows.agg(F.sum(F.when(held, F.col("source_size").cast("decimal(38,0)"))), F.sum(F.when(~held, F.col("weight")))).first()
        new = (budget - most * int(full or 0)) / int(free) if free else rate
        if new == rate or not free:
            break
        rate = new
    # No source above: its size times most, or its weight's share; at a tie both are the same.
    per_weight = float(rate) if rate is not None else 0.0
    own = F.col("source_size") * F.lit(float(most))
    return rows.withColumn("target", F.least(own, F.col("weight") * F.lit(per_weight)))


def fit_counts(size: np.ndarray, count: np.ndarray, target: float, table: int = TABLE) -> tuple[int, np.ndarray]:
    """Full passes over the documents, and how many of each size (ascending, above 0) are taken once
    more, for a sum near ``target``: at most one more pass, so never more than a pass above."""
    total = int((size * count).sum())
    if not total:
        return 0, np.zeros_like(count)
    whole = int(target // total)
    rest = target - whole * total
    taken = np.zeros_like(count)
    longest = int(size[-1])
    part = max(0.0, rest - longest) / total  # leaves the knapsack a longest text or two
    upto = np.floor(np.cumsum(count) * part).astype(np.int64)
    taken += np.diff(upto, prepend=0)
    left = rest - int((size * taken).sum())
    if left > table // 2:
        for i in range(len(size) - 1, -1, -1):
            more = min(int(count[i] - taken[i]), int(left // size[i]))
            taken[i] += more
            left -= more * int(size[i])
            if left <= table // 2:
                break
    taken += knapsack(size, count - taken, left, table)
    if total <= SMALL and abs(rest - (size * taken).sum()) > 0.5:
        every = knapsack(size, count, rest, table)
        if abs(rest - (size * every).sum()) < abs(rest - (size * taken).sum()):
            taken = every
    return whole, taken


def knapsack(size: np.ndarray, count: np.ndarray, goal: float, table: int) -> np.ndarray:
    """How many of each size, at most ``count``, come nearest to ``goal`` (of two, the lower): bounded
    knapsack over sums up to twice the goal, as picking nothing is never further off."""
    out = np.zeros_like(count)
    limit = min(table, int(2 * max(goal, 0)))
    aim = math.floor(goal + 0.5) if goal + 0.5 != math.floor(goal + 0.5) else math.floor(goal)
    reach = np.zeros(limit + 1, dtype=bool)
    reach[0] = True
    by = np.full(limit + 1, -1, dtype=np.int32)  # the bundle that first reached a sum
    bundles: list[tuple[int, int]] = []  # (index of the size, documents), each used once at most
    for i in np.flatnonzero((count > 0) & (size <= limit))[::-1].tolist():
        free, some = min(int(count[i]), limit // int(size[i])), 1
        while free > 0 and not reach[min(aim, limit)]:
            some = min(some, free)
            step = some * int(size[i])
            if step <= limit:
                new = reach[: limit + 1 - step] & ~reach[step:]
                at = np.flatnonzero(new) + step
                reach[at], by[at] = True, len(bundles)
                bundles.append((i, some))
            free, some = free - some, some * 2
        if reach[min(aim, limit)]:
            break
    sums = np.flatnonzero(reach)
    at = int(sums[np.lexsort((sums, np.abs(sums - goal)))[0]])
    while at:
        i, some = bundles[by[at]]
        out[i] += some
        at -= some * int(size[i])
    return out


def plan_lengths(lengths: DataFrame, table: int = TABLE) -> DataFrame:
    """``nth, size, whole, more`` from ``nth, size, n, target``: one source's lengths at a time. Words
    bound their number: k different lengths take k * k / 2 words at least."""
    def plan(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size")
        some = group["size"] > 0
        whole, more = fit_counts(group["size"][some].to_numpy(), group["n"][some].to_numpy(), float(group["target"].iloc[0]), table)
        out = group[["nth", "size"]].assign(whole=np.int64(whole), more=np.int64(0))
        out.loc[some, "more"] = more
        return out

    return lengths.groupBy("nth").applyInPandas(plan, "nth bigint, size bigint, whole bigint, more bigint")


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: tuple[int, ...] = WEIGHTS,
        share: Fraction = SHARE, most: int = MOST, seed: int = SEED, table: int = TABLE) -> DataFrame:
    """Per row the id, the source, ``size``, ``source_size``, ``target`` and ``taken``: how many words
    of it the mix takes, its size times the times it is taken.

    Null text has size 0 and takes nothing. A null source is a source, the last in order. Rows that
    repeat an id are each a document; rows alike in id and text tie, and either may be
    taken. Empty tables give no rows, tables without words targets of 0. Other columns aren't
    read, whatever their names. Runs with the same seed agree, whatever the partitions."""
    if share > most:
        raise ValueError("the share can't be above the most that every source gives")
    rows = stored(sized(docs, id_col, source_col, text_col, seed), "mix-sizes")
    slots = stored(rows.groupBy("source", "size", "slice").agg(F.count(F.lit(1)).alias("n")), "mix-lengths")
    sources = in_order(slots.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")))
    targets = stored(with_targets(sources, weights, share, most), "mix-targets")
    by_name = small_side(targets.withColumnRenamed("source", "named"))
    named = slots.join(by_name, F.col("source").eqNullSafe(F.col("named"))).select("nth", "size", "slice", "n", "target")
    lengths = named.groupBy("nth", "size").agg(F.sum("n").alias("n"), F.first("target").alias("target"))
    plan = plan_lengths(lengths, table)
    # Documents ahead of a slice of the hash: a running sum over at most HASH_SLICES rows.
    ahead = F.sum("n").over(Window.partitionBy("nth", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    dealt = stored(named.withColumn("ahead", F.coalesce(ahead, F.lit(0))).join(plan, ["nth", "size"]).select(
        "nth", "size", "slice", "whole", F.least(F.greatest(F.col("more") - F.col("ahead"), F.lit(0)), F.col("n")).alias("more"), "n"), "mix-plan")
    own = rows.join(by_name, F.col("source").eqNullSafe(F.col("named"))).drop("named", "weight").join(dealt, ["nth", "size", "slice"])
    # Only slices of which a part is taken need ranks.
    cut = (F.col("more") > 0) & (F.col("more") < F.col("n"))
    rank = F.row_number().over(Window.partitionBy("nth", "size", "slice").orderBy("draw"))
    first = own.filter(cut).withColumn("again", (rank <= F.col("more")).cast("bigint"))
    rest = own.filter(~cut).withColumn("again", (F.col("more") > 0).cast("bigint"))
    return first.unionByName(rest).select(F.col("key").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
                                          (F.col("size") * (F.col("whole") + F.col("again"))).alias("taken"))
