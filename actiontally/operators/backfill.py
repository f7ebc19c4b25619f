"""Recompute aggregates from the lake: whole ranges (backfill), or just the slots whose counts in the
table differ from the lake's (repair).

Every lake slot ``(event_date, event_hour)`` is exactly one UTC two-hour window, so the
window comes from the partition columns: no timestamp arithmetic per row, and a
backfill of a date range reads only that range's directories.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actiontally.functions.layout import SLOT_HOURS
from actiontally.functions.literals import day
from actiontally.operators.aggregates import totals_and_types, type_tag
from actiontally.operators.versions import lookup_aggregates
from actiontally.schemas import TOTAL_TAG
from actiontally.sources.changelog import read_current, write_changes
from actiontally.sources.lake import check_slots, lake_scan


def backfill_aggregations(lake: DataFrame, with_types: bool = True, user_col: str = "user_id",
                          type_col: str = "action_type") -> DataFrame:
    """Two-hour totals (and per-type counts) per user from lake rows, in the aggregate
    record form: user_id, window_start, window_end, total_actions, aggregation_type."""
    slot = ["user_id", "event_date", "event_hour"]
    if with_types:
        keyed = lake.select(F.col(user_col).alias("user_id"), "event_date", "event_hour", F.col(type_col).alias("action_type"))
        agg = totals_and_types(keyed, slot)
    else:
        agg = lake.groupBy(F.col(user_col).alias("user_id"), "event_date", "event_hour").agg(
            F.count(F.lit(1)).alias("total_actions")).withColumn("aggregation_type", F.lit(TOTAL_TAG))
    start = slot_start()
    end = start + F.make_dt_interval(hours=F.lit(SLOT_HOURS))
    return agg.select("user_id", start.alias("window_start"), end.alias("window_end"),
                      "total_actions", "aggregation_type")


#: Slots of a repair that are named in one scan; more are taken in turns.
SLOTS_AT_ONCE = 360


def slot_start(event_date: str = "event_date", event_hour: str = "event_hour") -> Column:
    return F.col(event_date).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col(event_hour))


def _digest(*key: Column) -> list[Column]:
    """Two independent hashes of a key, below 2^31, so that sums of them stay exact."""
    return [F.pmod(F.xxhash64(F.lit(salt), *key), F.lit((1 << 31) - 1)) for salt in (1, 2)]


def lake_digests(lake: DataFrame, with_types: bool = True, user_col: str = "user_id", type_col: str = "action_type") -> DataFrame:
    """``window_start, n, h1, h2`` per slot of the lake: its events, and order-free sums of hashes of each
    one's user (and type).  One aggregate by slot, so a few rows per task are shuffled."""
    key = [F.col(user_col)] + ([type_tag(type_col)] if with_types else [])
    one, two = _digest(*key)
    sums = lake.groupBy("event_date", "event_hour").agg(F.count(F.lit(1)).alias("n"), F.sum(one).alias("h1"), F.sum(two).alias("h2"))
    return sums.select(slot_start().alias("window_start"), "n", "h1", "h2")


def table_digests(current: DataFrame, with_types: bool = True) -> DataFrame:
    """The same of a table's current rows: a count of k actions weighs its key's hash k times, as its
    events do in the lake.  Equal digests so mean equal counts, but for chance (2^-62)."""
    tag = F.col("aggregation_type")
    rows = current.filter(tag != TOTAL_TAG) if with_types else current.filter(tag == TOTAL_TAG)
    one, two = _digest(F.col("user_id"), *([tag] if with_types else []))
    k = F.col("total_actions")
    return rows.groupBy("window_start").agg(F.sum(k).alias("n"), F.sum(one * k).alias("h1"), F.sum(two * k).alias("h2"))


def changed_slots(lake: DataFrame, current: DataFrame, with_types: bool = True, user_col: str = "user_id", type_col: str = "action_type") -> DataFrame:
    """``window_start, lake_n, table_n`` of the slots whose counts in the table are not those of the lake."""
    a, b = lake_digests(lake, with_types, user_col, type_col).alias("a"), table_digests(current, with_types).alias("b")
    same = F.lit(True)
    for c in ("n", "h1", "h2"):
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return a.join(b, "window_start", "full").filter(~same).select("window_start", F.coalesce("a.n", F.lit(0)).alias("lake_n"), F.coalesce("b.n", F.lit(0)).alias("table_n"))


def repair_slots(spark: SparkSession, lake_path: str, table_path: str, start, end, compacted: str | None = None, time_col: str = "event_time",
                 type_col: str = "action_type", with_types: bool = True) -> list[dt.datetime]:
    """Find the slots of ``[start, end)`` whose counts differ from the lake's (events that came after the
    watermark are in the lake, not in the table) and recompute just these; returns their starts.

    One pass over the user and type columns of the range finds them; only the changed slots' directories are
    read again.  Give closed slots.  Of a slot that the lake no longer holds, nothing is changed."""
    check_slots(start, end)
    lake = lake_scan(spark, lake_path, start=start, end=end, time_col=time_col)
    current = read_current(spark, table_path, compacted=compacted, keep_month=True)
    own = lookup_aggregates(current, start=start, end=end).filter(F.col("window_end") == F.col("window_start") + F.make_dt_interval(hours=F.lit(SLOT_HOURS)))
    found = sorted(r[0] for r in changed_slots(lake, own, with_types, type_col=type_col).filter("lake_n > 0").select("window_start").collect())  # slots of the range, twelve a day
    for a in range(0, len(found), SLOTS_AT_ONCE):
        some = found[a : a + SLOTS_AT_ONCE]
        days = {t.date() for t in some}
        which = F.lit(False)
        for d in sorted(days):
            which = which | ((F.col("event_date") == day(d)) & F.col("event_hour").isin([t.hour for t in some if t.date() == d]))
        rows = lake_scan(spark, lake_path, start=some[0], end=some[-1] + dt.timedelta(hours=SLOT_HOURS), time_col=time_col).filter(which)
        write_changes(backfill_aggregations(rows, with_types, type_col=type_col), table_path, 0, writer=f"repair_{uuid.uuid4().hex[:12]}")
    return found


def backfill_to_table(spark: SparkSession, lake_path: str, table_path: str, start, end, time_col: str = "event_time",
                      type_col: str = "action_type", dedup: bool = False, with_types: bool = True) -> str:
    """Recompute the slots of ``[start, end)`` from the lake as a writer of its own; returns
    its name.  The bounds must be slot bounds.  With ``dedup`` a repeated ``event_id``
    counts once.  Backfill closed slots: a stream that still holds a slot open writes its
    own count of it again."""
    check_slots(start, end)
    rows = lake_scan(spark, lake_path, start=start, end=end, time_col=time_col)
    if dedup:
        rows = rows.dropDuplicates(["event_id"])
    writer = f"backfill_{uuid.uuid4().hex[:12]}"
    write_changes(backfill_aggregations(rows, with_types, type_col=type_col), table_path, 0, writer=writer)
    return writer
