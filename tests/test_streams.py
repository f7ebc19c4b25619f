"""Structured Streaming: late data, restart on one checkpoint, fan-out, stream = batch."""

from __future__ import annotations

import datetime as dt
import time

import pytest

from pyspark.sql import functions as F

from actiontally.functions.decode import decode_events, split_corrupt
from actiontally.operators.aggregates import user_action_counts, user_aggregations
from actiontally.plans.fixtures import json_envelope, plain_events
from actiontally.sources.changelog import read_changes, read_current
from actiontally.operators.backfill import backfill_to_table
from actiontally.sources.lake import lake_scan, read_lake, read_landed, write_lake
from actiontally.streaming.jobs import (
    aggregate_stream, closed_window_stream, curate_slots, lake_stream, landing_stream, open_windows, run_to_completion, start_all,
)
from actiontally.streaming.staging import file_stream, replay_slices, undo_last_commit

T = dt.datetime
NOW = {"availableNow": True}
SCHEMA = "user_id long, event_time timestamp_ntz"


def _write_files(spark, path, files):
    for rows in files:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _late_run(spark, scratch, files):
    src, out = f"{scratch}/in", f"{scratch}/out"
    _write_files(spark, src, files)
    q = closed_window_stream(file_stream(spark, src, spark.createDataFrame([], SCHEMA).schema, 1), out,
                             f"{scratch}/ckpt", "2 hours", trigger=NOW)
    res = run_to_completion(q)
    got = {(r.user_id, r.window_start, r.window_end, r.total_actions) for r in spark.read.parquet(out).collect()}
    return got, res


T0 = [(1, T(2024, 1, 1, 0, 10)), (1, T(2024, 1, 1, 3, 0))]
T1 = [(1, T(2024, 1, 1, 3, 1))]
T2 = [(1, T(2024, 1, 1, 0, 30)), (1, T(2024, 1, 1, 2, 30))]
T3 = [(9, T(2024, 1, 2, 0, 0))]


def test_late_row_dropped_after_watermark_passed(spark, scratch):
    got, res = _late_run(spark, scratch, [T0, T1, T2, T3])
    assert got == {(1, T(2024, 1, 1, 0), T(2024, 1, 1, 2), 1), (1, T(2024, 1, 1, 2), T(2024, 1, 1, 4), 3)}
    assert res.dropped_late == 1


def test_late_row_of_an_open_window_counts(spark, scratch):
    got, res = _late_run(spark, scratch, [T0, T2, T3])
    assert res.dropped_late == 0
    assert (1, T(2024, 1, 1, 2), T(2024, 1, 1, 4), 2) in got


def test_redelivered_oldest_slice_is_dropped(spark, scratch):
    src = plain_events(spark, "/root/testdata/sf0.01").select("event_id", "ts", "user_id", "event_type")
    staged, out, ckpt = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ckpt"
    res = replay_slices(src, staged, "ts", lambda: closed_window_stream(
        file_stream(spark, staged, src.schema), out, ckpt, trigger=NOW, time_col="ts"), 6, replay_first=True)
    lo, hi = src.agg(F.min("ts"), F.max("ts")).first()
    first_slice = src.filter(F.col("ts") < F.lit((lo + (hi - lo) / 6).isoformat(sep=" ")).cast("timestamp_ntz"))
    # Late rows are filtered at the stateful operator, after the map-side partial
    # aggregate: the counter counts one row per (user, window) and input partition.
    assert res.dropped_late >= first_slice.select("user_id", F.window("ts", "2 hours")).distinct().count()
    assert res.input_rows == src.count() + first_slice.count()
    closed = user_action_counts(src, time_col="ts").filter(
        F.col("window_end") <= F.lit((hi - dt.timedelta(minutes=10)).isoformat(sep=" ")).cast("timestamp_ntz"))
    got = spark.read.parquet(out).select(*closed.columns)
    assert got.count() == closed.count() and got.exceptAll(closed).count() == 0


def test_time_skewed_input_is_replayed_slice_by_slice(spark, scratch):
    """Most events in the last sixth: the re-delivered slice still comes alone, and late."""
    e = plain_events(spark, "/root/testdata/sf0.01").select("event_id", "ts", "user_id", "event_type")
    skewed = e.filter("ts >= '2024-01-25' or event_id % 10 = 0").repartition(8)
    out, src = f"{scratch}/out", f"{scratch}/in"
    res = replay_slices(skewed, src, "ts", lambda: closed_window_stream(
        file_stream(spark, src, e.schema), out, f"{scratch}/ck", trigger=NOW, time_col="ts"), 6, replay_first=True)
    assert res.batches >= 7
    hi = skewed.agg(F.max("ts")).first()[0]
    want = user_action_counts(skewed, time_col="ts").filter(
        F.col("window_end") <= F.lit((hi - dt.timedelta(minutes=10)).isoformat(sep=" ")).cast("timestamp_ntz"))
    got = spark.read.parquet(out).select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_restart_on_same_checkpoint(spark, scratch):
    src = plain_events(spark, "/root/testdata/sf0.01").select("event_id", "ts", "user_id", "event_type")
    staged, table, ckpt = f"{scratch}/in", f"{scratch}/table", f"{scratch}/ckpt"

    def start():
        return aggregate_stream(file_stream(spark, staged, src.schema), table, ckpt, trigger=NOW,
                                time_col="ts", type_col="event_type")

    replay_slices(src.filter("ts < '2024-01-20'"), staged, "ts", start, 3)
    versions = read_changes(spark, table).select("version").distinct().count()
    again = run_to_completion(start())
    assert again.input_rows == 0
    assert read_changes(spark, table).select("version").distinct().count() == versions
    replay_slices(src.filter("ts >= '2024-01-20'"), staged, "ts", start, 2)
    want = user_aggregations(src, time_col="ts", type_col="event_type")
    got = read_current(spark, table).select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_fan_out_from_json_text_stream(spark, scratch):
    sf = "/root/testdata/sf0.001"
    text_dir = f"{scratch}/topic"
    env = json_envelope(spark, sf)
    env.write.mode("append").text(text_dir)
    raw = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(text_dir)
    events, _ = split_corrupt(decode_events(raw))
    qs = start_all(events, f"{scratch}/out", trigger=NOW, aggregates_from="source")
    for q in qs.values():
        run_to_completion(q)
    base = plain_events(spark, sf)
    assert read_lake(spark, f"{scratch}/out/lake").count() == base.count()
    want2h = user_aggregations(base, time_col="ts", type_col="event_type")
    got2h = read_current(spark, f"{scratch}/out/user_aggregations").select(*want2h.columns)
    assert got2h.count() == want2h.count() and got2h.exceptAll(want2h).count() == 0
    want5 = user_action_counts(base, "5 minutes", time_col="ts")
    got5 = read_current(spark, f"{scratch}/out/user_aggregations_realtime").select(*want5.columns)
    assert got5.count() == want5.count() and got5.exceptAll(want5).count() == 0


def _json_stream(spark, scratch, sf, copies=1):
    text_dir = f"{scratch}/topic"
    for _ in range(copies):
        json_envelope(spark, sf).write.mode("append").text(text_dir)
    raw = spark.readStream.schema("value string").text(text_dir)
    events, _ = split_corrupt(decode_events(raw))
    return events


def test_lake_stream_with_bucket_directories_then_curate(spark, scratch):
    sf = "/root/testdata/sf0.001"
    events = _json_stream(spark, scratch, sf)
    landing, lake = f"{scratch}/landing", f"{scratch}/lake"
    run_to_completion(lake_stream(events, landing, f"{scratch}/ckpt", NOW, bucket_dirs=True))
    landed = read_lake(spark, landing)
    assert landed.count() == plain_events(spark, sf).count()
    assert landed.filter(F.col("bucket") != F.pmod("user_id", F.lit(128))).count() == 0
    curate_slots(spark, landing, lake, "2024-01-01", "2024-02-01", bucket_dirs=False)
    cur = read_lake(spark, lake)
    assert cur.count() == landed.count()
    assert cur.select("event_id").exceptAll(landed.select("event_id")).count() == 0


def test_dedup_within_watermark_counts_repeats_once(spark, scratch):
    sf = "/root/testdata/sf0.001"
    events = _json_stream(spark, scratch, sf, copies=2)
    table = f"{scratch}/table"
    run_to_completion(aggregate_stream(events, table, f"{scratch}/ckpt", trigger=NOW, dedup=True))
    want = user_aggregations(plain_events(spark, sf), time_col="ts", type_col="event_type")
    got = read_current(spark, table).select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_stateful_queries_use_rocksdb(spark, scratch):
    events = _json_stream(spark, scratch, "/root/testdata/sf0.001")
    res = run_to_completion(aggregate_stream(events, f"{scratch}/t", f"{scratch}/ckpt", trigger=NOW))
    metrics = res.progress[0].stateOperators[0].customMetrics
    assert any(k.startswith("rocksdb") for k in metrics)


def test_new_checkpoint_must_say_where_it_starts(spark, scratch):
    """What the first query left open isn't replaced by a query that saw only later events."""
    src = plain_events(spark, "/root/testdata/sf0.01").select("event_id", "ts", "user_id", "event_type")
    table = f"{scratch}/table"
    src.filter("ts < '2024-01-15 01:00:00'").write.parquet(f"{scratch}/a")
    src.filter("ts >= '2024-01-15 01:00:00'").write.parquet(f"{scratch}/b")

    def start(name, since=None):
        return aggregate_stream(file_stream(spark, f"{scratch}/{name}", src.schema), table, f"{scratch}/ck_{name}",
                                trigger=NOW, time_col="ts", type_col="event_type", since=since)

    run_to_completion(start("a"))
    with pytest.raises(ValueError, match="since"):
        start("b")
    with pytest.raises(ValueError, match="does not start a window"):
        start("b", "2024-01-15 01:00:00")
    run_to_completion(start("b", "2024-01-15 02:00:00"))
    run_to_completion(start("b"))  # the checkpoint remembers
    want = user_aggregations(src.filter("ts < '2024-01-15 01:00:00' or ts >= '2024-01-15 02:00:00'"), time_col="ts", type_col="event_type")
    got = read_current(spark, table).select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_backfill_survives_a_running_stream(spark, scratch):
    """stream, backfill, one more batch of the stream: the backfilled slots keep their counts."""
    rows = lambda *r: spark.createDataFrame(list(r), "event_id long, ts timestamp_ntz, user_id long, event_type string")
    src, table, lake = f"{scratch}/in", f"{scratch}/t", f"{scratch}/lake"

    def run(more):
        more.write.mode("append").parquet(src)
        run_to_completion(aggregate_stream(file_stream(spark, src, more.schema), table, f"{scratch}/ck", trigger=NOW,
                                           time_col="ts", type_col="event_type"))

    day = T(2024, 1, 1)
    run(rows((1, day, 1, "x"), (2, day, 1, "x")))
    write_lake(rows((1, day, 1, "x"), (2, day, 1, "x"), (3, day, 1, "x")), lake, time_col="ts")
    backfill_to_table(spark, lake, table, day, T(2024, 1, 1, 2), time_col="ts", type_col="event_type")
    run(rows((9, T(2024, 1, 3), 2, "x")))
    got = {(r.user_id, r.total_actions) for r in read_current(spark, table).filter("aggregation_type = 'total'").collect()}
    assert got == {(1, 3), (2, 1)}


def test_late_repeated_and_malformed_records_all_land_somewhere(spark, scratch):
    env = [r.value for r in json_envelope(spark, "/root/testdata/sf0.001").limit(20).collect()]
    topic, root = f"{scratch}/topic", f"{scratch}/out"
    for batch in (env[10:], env[:10] + env[:3], ["garbage", '{"event_id":"e3","user_id":"bad"}']):
        spark.createDataFrame([(v,) for v in batch], "value string").coalesce(1).write.mode("append").text(topic)
    raw = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(topic)
    events, rejects = split_corrupt(decode_events(raw))
    for q in start_all(events, root, NOW, rejects=rejects, dedup=True, state_partitions=2).values():
        run_to_completion(q)
    assert read_lake(spark, f"{root}/lake").count() == 23
    assert spark.read.parquet(f"{root}/rejects").count() == 2
    curate_slots(spark, f"{root}/lake", f"{scratch}/lake", "2024-01-01", "2024-02-01", dedup=True)
    assert read_lake(spark, f"{scratch}/lake").count() == 20


def test_reports_beyond_those_a_query_keeps_are_counted(spark, scratch):
    spark.range(30).selectExpr("id user_id", "timestamp_ntz'2024-01-01' event_time").repartition(12).write.parquet(f"{scratch}/in")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        res = run_to_completion(lambda: aggregate_stream(
            file_stream(spark, f"{scratch}/in", spark.createDataFrame([], SCHEMA).schema, 1), f"{scratch}/t", f"{scratch}/ck",
            with_types=False, trigger=NOW))
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert res.input_rows == 30


def test_export_hook_receives_each_version(spark, scratch):
    events = _json_stream(spark, scratch, "/root/testdata/sf0.001")
    table, exported = f"{scratch}/t", f"{scratch}/exported"

    def export(df):
        df.write.mode("append").parquet(exported)

    run_to_completion(aggregate_stream(events, table, f"{scratch}/ckpt", trigger=NOW, export=export))
    ex = spark.read.parquet(exported)
    assert ex.columns == ["user_id", "window_start", "window_end", "total_actions", "aggregation_type", "updated_at"]
    assert ex.count() == read_changes(spark, table).count()
    assert ex.exceptAll(read_changes(spark, table).select(*ex.columns)).count() == 0


def test_stream_windows_do_not_depend_on_the_callers_zone(spark, scratch):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        src = plain_events(spark, "/root/testdata/sf0.001").select("event_id", "ts", "user_id", "event_type")
        src.write.parquet(f"{scratch}/in")
        run_to_completion(aggregate_stream(file_stream(spark, f"{scratch}/in", src.schema), f"{scratch}/t",
                                           f"{scratch}/ck", trigger=NOW, time_col="ts", type_col="event_type",
                                           output_files=2))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    want = user_aggregations(src, time_col="ts", type_col="event_type")
    got = read_current(spark, f"{scratch}/t").select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    assert len(spark.read.parquet(f"{scratch}/t").inputFiles()) <= 2


def test_stop_mid_stream_then_restart_equals_batch(spark, scratch):
    import time

    src = plain_events(spark, "/root/testdata/sf0.01").select("event_id", "ts", "user_id", "event_type")
    staged, table, ckpt = f"{scratch}/in", f"{scratch}/t", f"{scratch}/ck"
    for i in range(7):  # a file for five days each, oldest first
        src.filter(f"day(ts) > {5 * i} and day(ts) <= {5 * i + 5}").coalesce(1).write.mode("append").parquet(staged)

    def start(trigger):
        return aggregate_stream(file_stream(spark, staged, src.schema, 1), table, ckpt, trigger=trigger,
                                time_col="ts", type_col="event_type")

    q = start({"processingTime": "0 seconds"})
    deadline = time.time() + 120
    while time.time() < deadline and (q.lastProgress is None or q.lastProgress["batchId"] < 1):
        time.sleep(0.2)
    q.stop()  # interrupts whatever batch is running; it is replayed on restart
    run_to_completion(start(NOW))
    want = user_aggregations(src, time_col="ts", type_col="event_type")
    got = read_current(spark, table).select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_aggregates_fed_from_the_landing_lake(spark, scratch):
    sf = "/root/testdata/sf0.001"
    events = _json_stream(spark, scratch, sf)
    for q in start_all(events, f"{scratch}/out", trigger=NOW, state_partitions=4).values():
        run_to_completion(q)
    base = plain_events(spark, sf)
    want = user_aggregations(base, time_col="ts", type_col="event_type")
    got = read_current(spark, f"{scratch}/out/user_aggregations").select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_closed_windows_with_types(spark, scratch):
    src = plain_events(spark, "/root/testdata/sf0.001").select("event_id", "ts", "user_id", "event_type")
    src.write.parquet(f"{scratch}/in")
    run_to_completion(closed_window_stream(file_stream(spark, f"{scratch}/in", src.schema), f"{scratch}/out",
                                           f"{scratch}/ck", trigger=NOW, time_col="ts", with_types=True,
                                           type_col="event_type", output_files=2))
    hi = src.agg(F.max("ts")).first()[0]
    want = user_aggregations(src, time_col="ts", type_col="event_type").filter(
        F.col("window_end") <= F.lit((hi - dt.timedelta(minutes=10)).isoformat(sep=" ")).cast("timestamp_ntz"))
    got = spark.read.parquet(f"{scratch}/out").select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    assert len(spark.read.parquet(f"{scratch}/out").inputFiles()) <= 2 * 2  # ≤ 2 per micro-batch


GOOD = '{"event_id":"%s","user_id":%d,"action_type":"login","timestamp":"2026-01-01T%02d:00:00","metadata":{},"device_info":{}}'


def _text(spark, path, *lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def test_one_landing_query_for_events_and_rejects(spark, scratch):
    """Restarted after the sink's write and ahead of its commit, it lands nothing twice; one parse a record."""
    src, root = f"{scratch}/in", f"{scratch}/out"
    _text(spark, src, GOOD % ("a", 1, 1), "garbage", '{"event_id":"x"}')
    decoded = decode_events(spark.readStream.schema("value string").text(src))
    plans = []

    def land():
        q = landing_stream(decoded, f"{root}/lake", f"{root}/ckpt", NOW)
        q.awaitTermination()
        plans.append(q._jsq.explainInternal(True))

    land()
    undo_last_commit(spark, f"{root}/ckpt")
    _text(spark, src, GOOD % ("b", 2, 3), "rubbish")
    land()
    assert {r.event_id for r in read_lake(spark, f"{root}/lake").collect()} == {"a", "b"}
    assert read_lake(spark, f"{root}/lake").count() == 2 and "_corrupt" not in read_lake(spark, f"{root}/lake").columns
    assert sorted(r["_corrupt"] or "" for r in read_landed(spark, f"{root}/lake", "rejects").collect()) == ["", "garbage", "rubbish"]
    physical = plans[0][plans[0].index("== Physical Plan =="):]
    assert physical.count("from_json(") == 1
    day = lake_scan(spark, f"{root}/lake", start="2026-01-01 02:00:00", end="2026-01-01 04:00:00")
    assert [r.event_id for r in day.collect()] == ["b"]
    curate_slots(spark, f"{root}/lake", f"{root}/curated", "2026-01-01", "2026-01-02")
    assert {r.event_id for r in read_lake(spark, f"{root}/curated").collect()} == {"a", "b"}


def test_state_audit_sees_seeded_and_total_counts(spark, scratch):
    src = f"{scratch}/in"
    _write_files(spark, src, [T0 + T1])
    table, schema = f"{scratch}/table", spark.createDataFrame([], SCHEMA).schema
    aggregate_stream(file_stream(spark, src, schema), table, f"{scratch}/c1", "2 hours", False, trigger=NOW).awaitTermination()
    first = {(r.user_id, r.window_start, r.total_actions) for r in open_windows(spark, f"{scratch}/c1").collect()}
    assert (1, T(2024, 1, 1, 2), 2) in first
    _write_files(spark, f"{scratch}/in2", [[(1, T(2024, 1, 1, 3, 30))]])
    aggregate_stream(file_stream(spark, f"{scratch}/in2", schema), table, f"{scratch}/c2", "2 hours", False, trigger=NOW,
                     seed=read_current(spark, table)).awaitTermination()
    again = {(r.user_id, r.window_start, r.total_actions, r.aggregation_type) for r in open_windows(spark, f"{scratch}/c2").collect()}
    assert (1, T(2024, 1, 1, 2), 3, "total") in again


def test_refresh_follows_the_processing_time_trigger(spark, scratch):
    """The table is refreshed once a trigger interval (5 minutes by default, 4 seconds here), and holds what
    arrived before the refresh."""
    src, table = f"{scratch}/in", f"{scratch}/table"
    _write_files(spark, src, [T0])
    q = aggregate_stream(file_stream(spark, src, spark.createDataFrame([], SCHEMA).schema), table, f"{scratch}/ckpt", "5 minutes", False,
                         trigger={"processingTime": "4 seconds"}, state_partitions=2)
    try:
        deadline = time.time() + 60
        while not any(p.numInputRows for p in q.recentProgress) and time.time() < deadline:
            time.sleep(0.2)
        _write_files(spark, src, [T1])
        while sum(bool(p.numInputRows) for p in q.recentProgress) < 2 and time.time() < deadline:
            time.sleep(0.2)
        starts = [dt.datetime.fromisoformat(p.timestamp.rstrip("Z")) for p in q.recentProgress if p.numInputRows]
    finally:
        q.stop()
    assert read_current(spark, table).agg(F.sum("total_actions")).first()[0] == 3
    assert len(starts) == 2
    # Later batches start at multiples of the interval.
    assert round(starts[1].timestamp() * 1000) % 4000 < 500
