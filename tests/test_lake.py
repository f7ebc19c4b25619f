"""Lake layout, round trip, pruning and backfill."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from actiontally.operators.backfill import backfill_aggregations, backfill_to_table
from actiontally.operators.aggregates import user_aggregations
from actiontally.plans.fixtures import plain_events
from actiontally.sources.changelog import read_current
from actiontally.sources.lake import lake_scan, read_lake, write_lake
from tests.conftest import SF01


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_count_and_one_window_per_slot(spark, scratch):
    e = plain_events(spark, SF01)
    write_lake(e, scratch, time_col="ts")
    lake = read_lake(spark, scratch)
    assert lake.count() == e.count()
    per_slot = lake.groupBy("event_date", "event_hour").agg(
        F.countDistinct(F.window("ts", "2 hours").start).alias("n"))
    assert per_slot.filter("n != 1").count() == 0


def test_bucket_directories_when_forced(spark, scratch):
    e = plain_events(spark, "/root/testdata/sf0.001")
    write_lake(e, scratch, time_col="ts", bucket_dirs=True)
    lake = read_lake(spark, scratch)
    assert lake.count() == e.count()
    assert lake.filter(F.col("bucket") != F.pmod("user_id", F.lit(128))).count() == 0
    hit = lake_scan(spark, scratch, user_id=8, start="2024-01-05", end="2024-01-10", time_col="ts")
    assert "bucket" in _plan(hit).split("PartitionFilters")[1].split("]")[0]


def test_lookups_go_by_the_lakes_own_buckets(spark, scratch):
    e = plain_events(spark, SF01)
    write_lake(e, scratch, time_col="ts", n_buckets=64)
    assert lake_scan(spark, scratch, user_id=100, time_col="ts").count() == e.filter("user_id = 100").count() > 0
    with pytest.raises(ValueError, match="n_buckets"):
        write_lake(e, scratch, time_col="ts")


def test_a_landing_lake_is_read_through_its_commit_log(spark, scratch):
    from actiontally.streaming.jobs import lake_stream, run_to_completion

    e = plain_events(spark, "/root/testdata/sf0.001").withColumnRenamed("ts", "event_time")
    e.coalesce(1).write.parquet(f"{scratch}/in")
    lake = f"{scratch}/lake"
    run_to_completion(lake_stream(spark.readStream.schema(e.schema).parquet(f"{scratch}/in"), lake, f"{scratch}/ck", {"availableNow": True}))
    leaf = lake_scan(spark, lake, start="2024-01-05", end="2024-01-06").inputFiles()[0].replace("file:", "")
    shutil.copy(leaf, leaf.replace("part-", "part-copy-"))  # a file that no batch committed
    for end in ("2024-01-06", "2027-01-06"):
        want = e.filter(f"event_time >= '2024-01-05' and event_time < '{end}'").count()
        assert lake_scan(spark, lake, start="2024-01-05", end=end).count() == want


def test_ranges_that_cut_a_slot_are_refused(spark, scratch):
    from actiontally.streaming.jobs import curate_slots

    write_lake(plain_events(spark, SF01), f"{scratch}/lake", time_col="ts")
    for bad in (("2024-01-05 01:00:00", "2024-01-05 04:00:00"), ("2024-01-05", "2024-01-05 03:00:00")):
        with pytest.raises(ValueError, match="slot bound"):
            backfill_to_table(spark, f"{scratch}/lake", f"{scratch}/t", *bad, time_col="ts", type_col="event_type")
        with pytest.raises(ValueError, match="slot bound"):
            curate_slots(spark, f"{scratch}/lake", f"{scratch}/out", *bad, time_col="ts")


def test_lake_write_reads_its_input_once(spark, scratch):
    seen = spark.sparkContext.accumulator(0)
    rows = plain_events(spark, "/root/testdata/sf0.001")
    schema = rows.schema

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    write_lake(rows.mapInArrow(count, schema), scratch, time_col="ts")
    assert seen.value == rows.count()


def test_point_lookup_prunes_partitions_and_pushes_filters(spark, scratch):
    write_lake(plain_events(spark, SF01), scratch, time_col="ts")
    hit = lake_scan(spark, scratch, user_id=8, start="2024-01-05 03:00:00", end="2024-01-09 05:00:00",
                    time_col="ts")
    plan = _plan(hit)
    part = plan.split("PartitionFilters: [")[1].split("], ")[0]
    assert "event_date" in part
    pushed = plan.split("PushedFilters: [")[1].split("], ")[0]
    assert "user_id" in pushed and "bucket" in pushed
    assert hit.count() == 6


def test_single_day_lookup_prunes_slots(spark, scratch):
    write_lake(plain_events(spark, SF01), scratch, time_col="ts")
    hit = lake_scan(spark, scratch, start="2024-01-05 03:00:00", end="2024-01-05 07:00:00", time_col="ts")
    part = _plan(hit).split("PartitionFilters: [")[1].split("], ")[0]
    assert "event_hour" in part
    direct = plain_events(spark, SF01).filter("ts >= '2024-01-05 03:00:00' and ts < '2024-01-05 07:00:00'")
    assert hit.count() == direct.count()


def test_lookup_of_days_without_data_is_empty(spark, scratch):
    write_lake(plain_events(spark, SF01), scratch, time_col="ts")
    assert lake_scan(spark, scratch, start="2030-01-01", end="2030-01-03", time_col="ts").count() == 0


def test_dynamic_overwrite_replaces_only_touched_slots(spark, scratch):
    e = plain_events(spark, SF01)
    write_lake(e, scratch, time_col="ts")
    day = e.filter(F.to_date("ts") == F.lit("2024-01-03").cast("date"))
    write_lake(day, scratch, time_col="ts", mode="overwrite")
    assert read_lake(spark, scratch).count() == e.count()


def test_backfill_equals_stream_form(spark, scratch):
    e = plain_events(spark, SF01)
    write_lake(e, scratch, time_col="ts")
    back = backfill_aggregations(read_lake(spark, scratch), type_col="event_type")
    direct = user_aggregations(e, time_col="ts", type_col="event_type")
    assert back.exceptAll(direct).count() == 0 and direct.exceptAll(back).count() == 0


def test_backfill_range_into_table(spark, scratch):
    e = plain_events(spark, SF01)
    lake, table = f"{scratch}/lake", f"{scratch}/table"
    write_lake(e, lake, time_col="ts")
    backfill_to_table(spark, lake, table, "2024-01-01", "2024-02-01", time_col="ts", type_col="event_type")
    direct = user_aggregations(e, time_col="ts", type_col="event_type")
    cur = read_current(spark, table).select(*direct.columns)
    assert cur.exceptAll(direct).count() == 0 and cur.count() == direct.count()


def test_layout_is_fixed_per_lake(spark, scratch):
    e = plain_events(spark, "/root/testdata/sf0.001")
    write_lake(e.filter("ts < '2024-01-10'"), scratch, time_col="ts")
    with pytest.raises(ValueError, match="bucket_dirs"):
        write_lake(e.filter("ts >= '2024-01-10'"), scratch, time_col="ts", bucket_dirs=True)
    write_lake(e.filter("ts >= '2024-01-10'"), scratch, time_col="ts")
    assert read_lake(spark, scratch).count() == e.count()


def _scanned(df):
    """Rows that the scan of an executed DataFrame let through."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


def test_bloom_filters_skip_row_groups_that_ranges_cannot(spark, scratch):
    """Ids in random order: every file's range holds the id asked for, no file holds it."""
    rows = spark.range(40_000).select((F.xxhash64("id").bitwiseAND((1 << 40) - 2)).alias("event_id"), (F.col("id") % 50).alias("user_id"),
                                      F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id % 48 as int))").alias("event_time"))
    absent = (1 << 39) + 1  # odd: in none of them, and in the middle of their range
    for path, bloom in ((f"{scratch}/plain", ()), (f"{scratch}/bloom", ("event_id",))):
        write_lake(rows, path, bloom=bloom)
        scanned = _scanned(read_lake(spark, path).filter(F.col("event_id") == absent))
        assert scanned == 0 if bloom else scanned > 0
    held = rows.first().event_id
    hit = read_lake(spark, f"{scratch}/bloom").filter(F.col("event_id") == held)
    assert hit.count() == rows.filter(F.col("event_id") == held).count() and 0 < _scanned(hit) < 40_000
