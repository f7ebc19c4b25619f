"""The versioned table's sequence, seeded checkpoints, and compaction by user ranges."""

from __future__ import annotations

import bisect
import datetime as dt

import pytest
from pyspark.sql import functions as F

from actiontally.functions.ranges import key_ranges, range_id, sketch_columns, split_points
from actiontally.operators.aggregates import user_action_counts, user_aggregations
from actiontally.operators.backfill import backfill_to_table
from actiontally.operators.versions import compact_table, lookup_aggregates
from actiontally.plans.fixtures import plain_events
from actiontally.sources.changelog import (
    EXPORT_COLUMNS, claims, has_history, read_changes, read_current, remove_covered, user_splits, versions, write_changes,
)
from actiontally.sources.lake import write_lake
from actiontally.streaming.jobs import aggregate_stream, run_to_completion
from actiontally.streaming.staging import file_stream
from tests.conftest import SF01

T = dt.datetime
EVENT = "event_id long, user_id long, ts timestamp_ntz, event_type string"
EV = dict(time_col="ts", type_col="event_type", trigger={"availableNow": True}, state_partitions=4)


def _rows(spark, rows):
    return spark.createDataFrame(rows, "user_id long, window_start timestamp_ntz, window_end timestamp_ntz, total_actions long, aggregation_type string")


def _put(spark, path, rows):
    spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(path)


def _counts(df):
    return {(r.user_id, r.window_start, r.aggregation_type): r.total_actions for r in df.collect()}


def test_a_replayed_version_keeps_its_place(spark, scratch):
    row = lambda n: _rows(spark, [(1, T(2024, 1, 1), T(2024, 1, 1, 2), n, "total")])
    write_changes(row(2), scratch, 5, writer="stream")
    write_changes(row(3), scratch, 0, writer="backfill")
    first = {r.writer: r.updated_at for r in read_changes(spark, scratch).collect()}
    write_changes(row(2), scratch, 5, writer="stream")
    assert [r.total_actions for r in read_current(spark, scratch).collect()] == [3]
    assert {r.writer: r.updated_at for r in read_changes(spark, scratch).collect()} == first
    assert first["stream"] < first["backfill"]
    write_changes(row(4), scratch, 6, writer="stream")
    assert [r.total_actions for r in read_current(spark, scratch).collect()] == [4]
    assert [(c.number, c.version, c.writer) for c in claims(spark, scratch)] == [(1, 5, "stream"), (2, 0, "backfill"), (3, 6, "stream")]


def test_export_gets_the_rows_as_stamped(spark, scratch):
    sent = []
    write_changes(_rows(spark, [(1, T(2024, 1, 1), T(2024, 1, 1, 2), 3, "total")]), scratch, 0, export=lambda df: sent.extend(df.collect()))
    kept = read_changes(spark, scratch).select(*EXPORT_COLUMNS).collect()
    assert sent == kept and kept[0].updated_at is not None
    assert abs(kept[0].updated_at - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)) < dt.timedelta(minutes=5)


def test_rows_without_a_place_are_older(spark, scratch):
    old = _rows(spark, [(1, T(2024, 1, 1), T(2024, 1, 1, 2), 9, "total")]).withColumn("updated_at", F.lit("2099-01-01").cast("timestamp_ntz"))
    old.write.parquet(f"{scratch}/writer=a/version=0")
    write_changes(_rows(spark, [(1, T(2024, 1, 1), T(2024, 1, 1, 2), 4, "total")]), scratch, 0, writer="b")
    from actiontally.schemas import AGGREGATE

    assert [r.total_actions for r in read_current(spark, scratch, AGGREGATE).collect()] == [4]


def test_a_stream_batch_run_again_does_not_undo_a_backfill(spark, scratch):
    src, table, ckpt, lake = (f"{scratch}/{n}" for n in ("in", "t", "ck", "lake"))
    rows = [(i, 1, T(2024, 1, 1, 0, i), "a") for i in range(2)]
    _put(spark, src, rows)

    def start():
        return aggregate_stream(file_stream(spark, src, spark.createDataFrame([], EVENT).schema), table, ckpt, **EV)

    run_to_completion(start)
    write_lake(spark.createDataFrame([*rows, (9, 1, T(2024, 1, 1, 1), "a")], EVENT), lake, time_col="ts")
    backfill_to_table(spark, lake, table, "2024-01-01 00:00:00", "2024-01-01 02:00:00", time_col="ts", type_col="event_type")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(ckpt).getFileSystem(spark._jsc.hadoopConfiguration())
    assert fs.delete(path(f"{ckpt}/commits/0"), False)  # as if the run had ended ahead of its commit
    assert run_to_completion(start).batches
    assert set(_counts(read_current(spark, table)).values()) == {3}


@pytest.mark.parametrize("with_types,dedup", [(True, False), (False, False), (True, True)])
def test_a_seeded_checkpoint_goes_on_counting(spark, scratch, with_types, dedup):
    table, out = f"{scratch}/t", f"{scratch}/c"
    schema = spark.createDataFrame([], EVENT).schema
    one = [(1, 1, T(2024, 1, 1, 1), "a"), (2, 1, T(2024, 1, 1, 4, 5), "a"), (3, 1, T(2024, 1, 1, 4, 6), None), (4, 2, T(2024, 1, 1, 4, 7), "b")]
    two = [(5, 1, T(2024, 1, 1, 4, 8), "a"), (6, 2, T(2024, 1, 1, 5), None), (7, 3, T(2024, 1, 1, 9), "c")]
    _put(spark, f"{scratch}/in1", one)
    _put(spark, f"{scratch}/in2", two[:1] * (2 if dedup else 1))
    how = dict(EV, with_types=with_types, dedup=dedup)
    run_to_completion(lambda: aggregate_stream(file_stream(spark, f"{scratch}/in1", schema), table, f"{scratch}/k1", **how))
    compact_table(spark, table, out)
    assert remove_covered(spark, table, out) and not versions(spark, table) and has_history(spark, table)
    again = lambda **kw: aggregate_stream(file_stream(spark, f"{scratch}/in2", schema), table, f"{scratch}/k2", **how, **kw)
    with pytest.raises(ValueError, match="seed"):
        again()
    run_to_completion(lambda: again(seed=read_current(spark, table, compacted=out)))
    _put(spark, f"{scratch}/in2", two[1:])
    res = run_to_completion(again)  # restarted: neither the seed nor ``seed`` is needed again
    assert res.input_rows == 2
    events = spark.createDataFrame(one + two, EVENT)
    want = user_aggregations(events, time_col="ts", type_col="event_type") if with_types else \
        user_action_counts(events, time_col="ts").withColumn("aggregation_type", F.lit("total"))
    got = _counts(read_current(spark, table, compacted=out))
    assert got == _counts(want)
    assert all(k[2] for k in got)


def test_a_record_without_a_type_has_a_tag(spark):
    rows = spark.createDataFrame([(1, 1, T(2024, 1, 1, 1), None), (2, 1, T(2024, 1, 1, 1), "a")], EVENT)
    got = _counts(user_aggregations(rows, time_col="ts", type_col="event_type"))
    assert {k[2]: v for k, v in got.items()} == {"total": 2, "action:(none)": 1, "action:a": 1}


def test_ranges_follow_the_split_points(spark):
    users = [None, *range(-3, 40)]
    df = spark.createDataFrame([(u, i) for u in users for i in range(20)], "u bigint, w int")
    for splits in ([], [5], [5, 5, 5, 20], list(range(0, 39, 3)), [7] * 6):
        for r in df.select("u", "w", range_id(F.col("u"), splits, F.col("w")).alias("id")).collect():
            low, high = key_ranges(r.u, splits) if r.u is not None else (0, 0)
            assert low <= r.id <= high and (r.u is None or low == bisect.bisect_left(splits, r.u))
    spread = df.filter("u = 5").select(range_id(F.col("u"), [5, 5, 5, 20], F.col("w")).alias("id")).distinct().count()
    assert spread == 3


def test_merged_sketches_balance_the_ranges(spark):
    one, two = (spark.range(lo, hi).selectExpr("id u").agg(*sketch_columns("u")).first().asDict() for lo, hi in ((0, 5000), (5000, 20000)))
    splits = split_points([one, two, {"n": 0, "points": None}], 1000)
    assert len(splits) == 19
    sizes = [b - a for a, b in zip([0, *splits], [*splits, 20000])]
    assert max(sizes) < 1300 and min(sizes) > 700
    assert split_points([], 10) == [] and split_points([{"n": 0, "points": None}], 10) == []
    hot = spark.range(9000).selectExpr("if(id % 3 = 0, 4, id) u").agg(*sketch_columns("u")).first().asDict()
    assert split_points([hot], 1000).count(4) >= 2


def test_a_lookup_opens_its_own_files(spark, scratch):
    table, out, second = f"{scratch}/t", f"{scratch}/c", f"{scratch}/c2"
    e = plain_events(spark, SF01)
    for v, rows in enumerate((e.filter(F.hour("ts") < 12), e)):
        write_changes(user_aggregations(rows, time_col="ts", type_col="event_type"), table, v)
    compact_table(spark, table, out, rows_per_range=1500)
    splits, base = user_splits(spark, out), spark.read.parquet(out)
    months = base.select("yyyymm").distinct().count()
    assert len(splits) > 10 and base.select("user_range").distinct().count() == len(splits) + 1
    files = base.withColumn("file", F.input_file_name()).groupBy("yyyymm", "user_range").agg(F.countDistinct("file").alias("n"), F.min("user_id").alias("lo"), F.max("user_id").alias("hi")).collect()
    assert all(f.n == 1 for f in files)
    ordered = sorted((f.user_range, f.lo, f.hi) for f in files if f.yyyymm == files[0].yyyymm)
    assert all(a[2] <= b[1] for a, b in zip(ordered, ordered[1:]))
    for user in (8, 77, 149):
        hit = lookup_aggregates(base, user, "total", splits=splits)
        plan = hit._jdf.queryExecution().executedPlan().toString()
        assert "user_range" in plan.split("PartitionFilters: [")[1].split("], ")[0]
        read = {f for f in base.inputFiles() if any(f"user_range={r}/" in f for r in range(*(lambda a, b: (a, b + 1))(*key_ranges(user, splits))))}
        assert len(read) <= 2 * months
        assert hit.count() == base.filter(f"user_id = {user} and aggregation_type = 'total'").count() > 0
    # The next compaction starts from this one and its sketch; readers add what it does not cover.
    write_changes(_rows(spark, [(8, T(2024, 1, 5), T(2024, 1, 5, 2), 1000, "total")]), table, 2)
    cur = lookup_aggregates(read_current(spark, table, compacted=out, keep_month=True), 8, "total", "2024-01-05", "2024-01-06", splits)
    scans = cur._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1:]
    assert any("user_range" in scan.split("], ")[0] for scan in scans)
    assert (8, T(2024, 1, 5), "total", 1000) in {(r.user_id, r.window_start, r.aggregation_type, r.total_actions) for r in cur.collect()}
    compact_table(spark, table, second, previous=out, rows_per_range=1500)
    assert len(user_splits(spark, second)) == spark.read.parquet(out).count() // 1500  # by what the first one holds
    want = _counts(read_current(spark, table))
    assert _counts(spark.read.parquet(second)) == want


def test_compaction_reads_its_input_once(spark, scratch):
    table, out = f"{scratch}/t", f"{scratch}/c"
    for v in range(2):
        write_changes(_rows(spark, [(u, T(2024, 1, 1), T(2024, 1, 1, 2), v, "total") for u in range(50)]), table, v)
    seen = spark.sparkContext._jsc.sc()
    seen.listenerBus().waitUntilEmpty()
    jobs = lambda: spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(seen.statusStore().jobsList(None)).size()
    before = jobs()
    compact_table(spark, table, out, rows_per_range=10)
    seen.listenerBus().waitUntilEmpty()
    assert len(user_splits(spark, out)) == 9
    # The write's own stages, and the schema read of the Parquet footers.
    assert jobs() - before <= 3


def test_a_plan_of_compaction_has_one_exchange(spark, scratch):
    from actiontally.operators.versions import latest_versions
    from actiontally.schemas import AGG_KEY

    write_changes(_rows(spark, [(u, T(2024, 1, 1), T(2024, 1, 1, 2), 1, "total") for u in range(9)]), scratch, 0)
    dealt = read_changes(spark, scratch).withColumn("user_range", range_id(F.col("user_id"), [3, 6], F.col("window_start"))).repartitionById(3, F.col("user_range"))
    plan = latest_versions(dealt, key=["user_range", *AGG_KEY])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
