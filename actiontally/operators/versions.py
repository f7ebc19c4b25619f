"""The versioned aggregate table: newest-version-wins collapse, key lookups, row expiry
and compaction into month partitions sorted by key."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actiontally.functions.layout import yyyymm
from actiontally.functions.literals import as_datetime, ntz
from actiontally.functions.ranges import key_ranges, range_id, sketch_columns, split_points
from actiontally.schemas import AGG_KEY
from actiontally.sources.changelog import covered, read_changes, read_sketch, versions, write_covered, write_sketched, write_text


def write_order(changes: DataFrame) -> F.Column:
    """A number that grows with the version's place in the table's sequence; versions that claimed
    their place at the same moment are told apart by a hash, alike for every reader.  Rows without a
    place (of tables written before there was one) are older than all others, by ``updated_at``;
    rows without a writer are ordered by ``version``."""
    if not {"writer", "updated_at"} <= set(changes.columns):
        return F.col("version").cast("bigint")
    tie = F.pmod(F.xxhash64("writer", "version"), F.lit(1000))
    old = F.unix_micros(F.col("updated_at").cast("timestamp")) * 1000 + tie - F.lit(1 << 62)
    if "sequence" not in changes.columns:
        return old
    return F.coalesce(F.col("sequence") * 1000 + tie, old)


def latest_versions(changes: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Keep the row written last per key.

    An aggregate, not a ranking window: a partial aggregate runs before the shuffle and
    no key's history is ever gathered into one task.  One ``max_by`` per column (the
    order is unique per key, so all pick the same row) keeps every buffer
    fixed-width for the value columns of the aggregate tables, which lets Spark use a
    hash aggregate instead of sorting on both sides of the shuffle.
    """
    key = key or AGG_KEY
    order = write_order(changes)
    return changes.groupBy(*key).agg(*(F.max_by(F.col(c), order).alias(c) for c in changes.columns if c not in key))


def current_rows(changes: DataFrame, key: list[str] | None = None, keep_month: bool = False) -> DataFrame:
    """Current rows of an aggregate change log, with the bookkeeping columns dropped.
    ``yyyymm`` and ``user_range`` are functions of the key, so they may join it (``keep_month``):
    predicates on them then reach the scan's partitions."""
    layout = [c for c in ("yyyymm", "user_range") if c in changes.columns]
    if keep_month:
        key = [*layout, *(key or AGG_KEY)]
    return latest_versions(changes, key).drop("updated_at", "version", "writer", "sequence", *([] if keep_month else layout))


def lookup_aggregates(table: DataFrame, user_id: int | None = None, aggregation_type: str | None = None,
                      start: str | dt.datetime | None = None, end: str | dt.datetime | None = None,
                      splits: list[int] | None = None) -> DataFrame:
    """Rows by key prefix and a ``[start, end)`` range of ``window_start``.

    On a compacted table (``yyyymm`` partition column) each bound's month is added as a
    partition predicate, which Spark cannot derive from the ``window_start`` bounds, and with the
    compaction's ``splits`` (``user_splits``) the user's range is too: one file a month, more only
    for a user whose rows fill several ranges.
    Key predicates reach the Parquet reader, whose row-group statistics skip data in
    files sorted by the key.
    """
    cond = F.lit(True)
    if user_id is not None:
        cond = cond & (F.col("user_id") == F.lit(user_id))
    if aggregation_type is not None:
        cond = cond & (F.col("aggregation_type") == F.lit(aggregation_type))
    if start is not None:
        cond = cond & (F.col("window_start") >= ntz(start))
    if end is not None:
        cond = cond & (F.col("window_start") < ntz(end))
    if user_id is not None and splits is not None and "user_range" in table.columns:
        cond = cond & F.col("user_range").between(*key_ranges(user_id, splits))
    if "yyyymm" in table.columns:
        month = lambda t: t.year * 100 + t.month
        if start is not None:
            cond = cond & (F.col("yyyymm") >= F.lit(month(as_datetime(start))))
        if end is not None:
            cond = cond & (F.col("yyyymm") <= F.lit(month(as_datetime(end) - dt.timedelta(microseconds=1))))
    return table.filter(cond)


def expire_before(table: DataFrame, as_of: str | dt.datetime, ttl: str = "7 days") -> DataFrame:
    """Rows still alive at ``as_of`` under ``window_start + ttl > as_of``; ``as_of`` is
    explicit.  Written as ``window_start > as_of - ttl`` so the bound folds to a literal
    and reaches the Parquet reader (row groups of expired windows are skipped)."""
    return table.filter(F.col("window_start") > (ntz(as_of) - F.expr(f"INTERVAL {ttl}")))


def month_summary(table: DataFrame) -> DataFrame:
    """Rows and actions per month partition of an aggregate table."""
    m = F.col("yyyymm") if "yyyymm" in table.columns else yyyymm("window_start")
    return table.groupBy(m.alias("yyyymm")).agg(F.count(F.lit(1)).alias("n_rows"),
                                                 F.sum("total_actions").cast("bigint").alias("actions"))


#: Rows of a user range, all months together.
ROWS_PER_RANGE = 1_000_000


def compact(changes: DataFrame, out_path: str, ttl_as_of: str | dt.datetime | None = None,
            ttl: str = "7 days", rows_per_range: int = ROWS_PER_RANGE, covers: list[str] | None = None,
            sketches: list[dict] | None = None) -> None:
    """Collapse a change log and rewrite it by month and range of users, sorted by the table key.

    One shuffle of the rows, read once: split points come from the ``sketches`` of the users (those the
    versions keep; without any the user column is read once more). A task holds one range of
    users, all months, so the newest-version collapse runs without another exchange, and a month has one
    file for each range. A user with more rows than a range is spread over several by window. Range
    and month are functions of the key and partition columns, so a lookup opens its own files
    only. Writes a new directory: readers switch to it; files under a live sink are never
    rewritten. With ``ttl_as_of`` expired rows are purged on the way.

    ``covers`` names the versions behind ``changes``; it is recorded beside the result
    (``compact_table`` does so), so readers can add those that came later.
    """
    spark = changes.sparkSession
    if ttl_as_of is not None:
        changes = expire_before(changes, ttl_as_of, ttl)
    if sketches is None:
        sketches = [changes.agg(*sketch_columns("user_id")).first().asDict()]
    splits = split_points(sketches, rows_per_range)
    dealt = changes.withColumns({"yyyymm": yyyymm("window_start"), "user_range": range_id(F.col("user_id"), splits, F.col("window_start"))})
    dealt = dealt.repartitionById(len(splits) + 1, F.col("user_range"))
    cur = latest_versions(dealt, key=["yyyymm", "user_range", *AGG_KEY])
    layout = ["yyyymm", "user_range"]
    write_sketched(cur.sortWithinPartitions(*layout, "user_id", "aggregation_type", "window_start", "window_end"), out_path, layout)
    write_text(spark, f"{out_path}/_splits", json.dumps(splits))
    if covers is not None:
        write_covered(spark, out_path, covers)


def compact_table(spark: SparkSession, table_path: str, out_path: str, previous: str | None = None,
                  ttl_as_of: str | dt.datetime | None = None, ttl: str = "7 days", rows_per_range: int = ROWS_PER_RANGE) -> list[str]:
    """Compact the versions committed now (with ``previous``: that compaction and those it
    doesn't cover).  Returns the versions covered.  A version that is still being written
    is left to the next compaction, whatever its number."""
    now = versions(spark, table_path)
    old = covered(spark, previous) if previous else []
    new = sorted(set(now) - set(old))
    parts = [spark.read.parquet(previous).withColumn("version", F.col("version").cast("long")).drop("yyyymm", "user_range")] if previous else []
    if new or not parts:
        parts.append(read_changes(spark, table_path, only=new))
    changes = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    found = [read_sketch(spark, p) for p in [*([previous] if previous else []), *(f"{table_path}/{v}" for v in new)]]
    compact(changes, out_path, ttl_as_of, ttl, rows_per_range, covers=sorted({*old, *new}), sketches=found if all(found) else None)
    return sorted({*old, *new})
