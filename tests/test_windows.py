"""Window edges and the invariants between the aggregates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from actiontally.operators.aggregates import user_action_counts, user_aggregations
from actiontally.plans.fixtures import plain_events
from tests.conftest import SF01


def test_window_end_is_exclusive(spark):
    ev = spark.createDataFrame(
        [(1, "a", dt.datetime(2024, 1, 1, 3, 59, 59, 999000)), (1, "a", dt.datetime(2024, 1, 1, 4, 0, 0))],
        "user_id long, action_type string, event_time timestamp_ntz")
    got = {(r.window_start.hour, r.window_end.hour): r.total_actions
           for r in user_action_counts(ev, "2 hours").collect()}
    assert got == {(2, 4): 1, (4, 6): 1}


def test_null_action_type_is_not_the_total(spark):
    ev = spark.createDataFrame([(1, None, dt.datetime(2024, 1, 1, 0, 5)), (1, "a", dt.datetime(2024, 1, 1, 0, 6))],
                               "user_id long, action_type string, event_time timestamp_ntz")
    tags = sorted((r.aggregation_type or "<null>", r.total_actions)
                  for r in user_aggregations(ev).collect())
    assert tags == [("<null>", 1), ("action:a", 1), ("total", 2)]


def test_total_equals_sum_of_types(spark):
    u = user_aggregations(plain_events(spark, SF01), time_col="ts", type_col="event_type")
    key = ["user_id", "window_start", "window_end"]
    tot = u.filter("aggregation_type = 'total'").select(*key, F.col("total_actions").alias("t"))
    parts = u.filter("aggregation_type != 'total'").groupBy(*key).agg(F.sum("total_actions").alias("s"))
    assert tot.join(parts, key, "full").filter("t is null or s is null or t != s").count() == 0


def test_five_minute_counts_sum_to_two_hour_counts(spark):
    e = plain_events(spark, SF01)
    five = user_action_counts(e, "5 minutes", time_col="ts").withColumn(
        "slot", F.window("window_start", "2 hours").start).groupBy("user_id", "slot") \
        .agg(F.sum("total_actions").alias("s"))
    two = user_action_counts(e, "2 hours", time_col="ts").select(
        "user_id", F.col("window_start").alias("slot"), F.col("total_actions").alias("t"))
    assert two.join(five, ["user_id", "slot"], "full").filter("t is null or s is null or t != s").count() == 0
    assert two.agg(F.sum("t")).first()[0] == e.count()
