"""Ranges of a sorted key: quantile sketches, split points, and the range of a row.

A sketch is the number of rows and equally spaced quantiles of the key. Sketches of several
parts are merged as weighted points; they only balance the ranges, so an approximation is enough.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Quantiles of a sketch.
POINTS = 256


def sketch_columns(key: str) -> list[Column]:
    """Aggregates that give a sketch of ``key``: ``n`` and ``points`` (null without rows)."""
    return [F.count(F.lit(1)).alias("n"), F.percentile_approx(key, [(i + 0.5) / POINTS for i in range(POINTS)], 10_000).alias("points")]


def split_points(sketches: list[dict], rows_per_range: int) -> list[int]:
    """Upper bounds of all ranges but the last, for about ``rows_per_range`` rows in each. A key that
    fills several ranges is repeated."""
    total = sum(s["n"] for s in sketches if s["points"])
    parts = max(1, -(-total // max(1, rows_per_range)))
    weighted = sorted((p, s["n"] / len(s["points"])) for s in sketches if s["points"] for p in s["points"])
    out, seen = [], 0.0
    for p, w in weighted:
        seen += w
        while len(out) < parts - 1 and seen * parts >= total * (len(out) + 1):
            out.append(p)
    return out


def _search(key: Column, splits: list[int], right: bool) -> Column:
    """How many of the sorted ``splits`` are below ``key`` (or, with ``right``, not above it): a binary
    search, as many steps as the list's length has bits. 0 for a null key."""
    steps = [1 << i for i in range(len(splits).bit_length() - 1, -1, -1)]
    at = F.array(*map(F.lit, splits))

    def step(found: Column, width: Column) -> Column:
        value = F.get(at, found + width - 1)  # null beyond the end
        return F.when(value <= key if right else value < key, found + width).otherwise(found)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def range_id(key: Column, splits: list[int], spread: Column) -> Column:
    """The range of a row by its key: range i holds the keys above split i - 1 and up to split i. Rows of
    a key that is split point more than once are spread over its ranges by a hash of ``spread``."""
    if not splits:
        return F.lit(0)
    low = _search(key, splits, False)
    if len(set(splits)) == len(splits):
        return low
    width = _search(key, splits, True) - low
    return low + F.when(width > 1, F.pmod(F.hash(spread), width)).otherwise(0)


def key_ranges(key: int, splits: list[int]) -> tuple[int, int]:
    """First and last range that rows of a key can lie in."""
    low, high = sum(s < key for s in splits), sum(s <= key for s in splits)
    return low, max(low, high - 1)
