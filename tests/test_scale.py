"""Plan shape and skew: what must hold at full scale, checked on small inputs."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from actiontally.operators.aggregates import user_action_counts, user_aggregations
from actiontally.operators.versions import latest_versions
from actiontally.plans.catalog import QUERIES
from actiontally.plans.fixtures import plain_events
from actiontally.sources.lake import read_lake, write_lake
from tests.conftest import SF001, SF01

FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "CartesianProduct",
             "BroadcastNestedLoopJoin", "BroadcastExchange", "Window ", "SortAggregate", "collect_list"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_plans_stay_on_the_jvm_fast_path(spark, name):
    plan = _plan(QUERIES[name](spark, SF001))
    assert not [f for f in FORBIDDEN if f in plan], plan


def _hot(spark):
    """sf0.01 events with user 0 owning every third event (a third of all rows),
    one slot holding a third of the rows too."""
    e = plain_events(spark, SF01)
    hot = F.col("event_id") % 3 == 0
    return e.select(
        "event_id", "event_type",
        F.when(hot, F.lit(0)).otherwise(F.col("user_id")).cast("long").alias("user_id"),
        F.when(hot, F.lit("2024-01-15 10:00:00").cast("timestamp_ntz") + F.make_dt_interval(
            secs=(F.col("event_id") % 7000).cast("decimal(18,6)") / 1000)).otherwise(F.col("ts")).alias("ts"))


def test_hot_user_aggregates_combine_before_the_shuffle(spark):
    agg = user_aggregations(_hot(spark), time_col="ts", type_col="event_type")
    plan = _plan(agg)
    ex = plan.index("Exchange hashpartitioning")
    assert "partial_count" in plan[ex:]  # partial aggregate below the exchange
    totals = agg.filter("aggregation_type = 'total'").agg(F.sum("total_actions")).first()[0]
    assert totals == 10_000


def test_hot_user_counts_match_brute_force(spark):
    pdf = _hot(spark).toPandas()
    con = duckdb.connect()
    con.register("hot", pdf)
    want = con.execute("""select user_id, time_bucket(interval '2 hours', ts, timestamp '1970-01-01') ws,
                          count(*) n from hot group by all""").fetchall()
    got = user_action_counts(_hot(spark), time_col="ts").select("user_id", "window_start", "total_actions")
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_hot_user_is_split_across_lake_files(spark, scratch):
    write_lake(_hot(spark), scratch, time_col="ts", bucket_dirs=False)
    lake = read_lake(spark, scratch)
    files = lake.filter("user_id = 0").select(F.input_file_name()).distinct().count()
    assert files >= 2
    assert lake.count() == 10_000


def test_version_collapse_is_partial_aggregated(spark):
    ch = user_action_counts(_hot(spark), time_col="ts").withColumn("aggregation_type", F.lit("total")) \
        .withColumn("version", F.lit(1).cast("long"))
    plan = _plan(latest_versions(ch))
    assert "partial_max_by" in plan and "SortAggregate" not in plan
