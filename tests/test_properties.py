"""Property tests against brute force: windowed counts and newest-version collapse."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from actiontally.operators.aggregates import user_action_counts, user_aggregations
from actiontally.operators.versions import latest_versions

EPOCH = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

events = st.lists(
    st.tuples(st.integers(0, 4), st.sampled_from(["a", "b", None]),
              st.integers(0, 3 * 24 * 3600 * 1000).map(lambda ms: EPOCH + dt.timedelta(milliseconds=ms))),
    min_size=1, max_size=60)


def _floor(t: dt.datetime, seconds: int) -> dt.datetime:
    s = int((t - dt.datetime(1970, 1, 1)).total_seconds() // seconds * seconds)
    return dt.datetime(1970, 1, 1) + dt.timedelta(seconds=s)


@SETTINGS
@given(rows=events, minutes=st.sampled_from([5, 120]))
def test_counts_match_brute_force(spark, rows, minutes):
    df = spark.createDataFrame(rows, "user_id long, action_type string, event_time timestamp_ntz")
    got = Counter({(r.user_id, r.window_start): r.total_actions
                   for r in user_action_counts(df, f"{minutes} minutes").collect()})
    want = Counter((u, _floor(t, minutes * 60)) for u, _, t in rows)
    assert got == want


@SETTINGS
@given(rows=events)
def test_long_table_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "user_id long, action_type string, event_time timestamp_ntz")
    got = Counter({(r.user_id, r.window_start, r.window_end - r.window_start, r.aggregation_type): r.total_actions
                   for r in user_aggregations(df).collect()})
    want = Counter()
    for u, a, t in rows:
        w = _floor(t, 7200)
        want[(u, w, dt.timedelta(hours=2), "total")] += 1
        want[(u, w, dt.timedelta(hours=2), None if a is None else f"action:{a}")] += 1
    assert got == want


@SETTINGS
@given(changes=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 100)),
                        min_size=1, max_size=40, unique_by=lambda c: (c[0], c[1])))
def test_newest_version_wins(spark, changes):
    rows = [(u, "total", EPOCH, EPOCH + dt.timedelta(hours=2), n, v) for u, v, n in changes]
    df = spark.createDataFrame(rows, "user_id long, aggregation_type string, window_start timestamp_ntz, "
                                     "window_end timestamp_ntz, total_actions long, version long")
    got = {r.user_id: (r.version, r.total_actions) for r in latest_versions(df).collect()}
    want = {}
    for u, v, n in changes:
        if u not in want or v > want[u][0]:
            want[u] = (v, n)
    assert got == want


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(user=st.one_of(st.none(), st.integers(0, 14)),
       start_min=st.integers(0, 31 * 24 * 60), length_min=st.integers(1, 6 * 24 * 60))
def test_lake_scan_prunes_without_losing_rows(spark, landed_lake, user, start_min, length_min):
    from pyspark.sql import functions as F

    from actiontally.plans.fixtures import plain_events
    from actiontally.sources.lake import lake_scan
    from tests.conftest import SF001

    start = EPOCH + dt.timedelta(minutes=start_min)
    end = start + dt.timedelta(minutes=length_min)
    got = lake_scan(spark, landed_lake, user_id=user, start=start, end=end, time_col="ts")
    want = plain_events(spark, SF001).filter(
        (F.col("ts") >= F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz"))
        & (F.col("ts") < F.lit(end.isoformat(sep=" ")).cast("timestamp_ntz")))
    if user is not None:
        want = want.filter(F.col("user_id") == user)
    assert sorted(r.event_id for r in got.select("event_id").collect()) == \
        sorted(r.event_id for r in want.select("event_id").collect())
