"""Newest-version-wins, ties, expiry, compaction and key lookups."""

from __future__ import annotations

import datetime as dt


from actiontally.operators.versions import (
    compact, compact_table, current_rows, expire_before, latest_versions, lookup_aggregates,
)
from actiontally.sources.changelog import covered, read_changes, read_current, remove_covered, versions, write_changes

T = dt.datetime


def _rows(spark, rows):
    return spark.createDataFrame(rows, "user_id long, window_start timestamp_ntz, window_end timestamp_ntz, "
                                       "total_actions long, aggregation_type string")


def test_equal_updated_at_is_decided_by_version(spark):
    same = T(2024, 1, 1, 12)
    ch = spark.createDataFrame(
        [(1, "total", T(2024, 1, 1), T(2024, 1, 1, 2), 3, same, 0),
         (1, "total", T(2024, 1, 1), T(2024, 1, 1, 2), 5, same, 2),
         (1, "total", T(2024, 1, 1), T(2024, 1, 1, 2), 4, same, 1),
         (2, "total", T(2024, 1, 1), T(2024, 1, 1, 2), 9, same, 0)],
        "user_id long, aggregation_type string, window_start timestamp_ntz, window_end timestamp_ntz, "
        "total_actions long, updated_at timestamp_ntz, version long")
    got = {(r.user_id, r.total_actions, r.version) for r in latest_versions(ch).collect()}
    assert got == {(1, 5, 2), (2, 9, 0)}


def test_collapse_is_an_aggregate_not_a_ranking_window(spark):
    ch = spark.createDataFrame([(1, "total", T(2024, 1, 1), T(2024, 1, 1, 2), 3, 0)],
                               "user_id long, aggregation_type string, window_start timestamp_ntz, "
                               "window_end timestamp_ntz, total_actions long, version long")
    plan = latest_versions(ch)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortAggregate" not in plan and "max_by" in plan


def test_replayed_version_is_idempotent(spark, scratch):
    rows = _rows(spark, [(1, T(2024, 1, 1), T(2024, 1, 1, 2), 3, "total")])
    write_changes(rows, scratch, 7)
    write_changes(rows, scratch, 7)
    assert read_changes(spark, scratch).count() == 1


def test_key_in_one_version_only_survives(spark, scratch):
    write_changes(_rows(spark, [(1, T(2024, 1, 1), T(2024, 1, 1, 2), 3, "total")]), scratch, 0)
    write_changes(_rows(spark, [(2, T(2024, 1, 1), T(2024, 1, 1, 2), 4, "total"),
                                (1, T(2024, 1, 1), T(2024, 1, 1, 2), 6, "total")]), scratch, 1)
    got = {(r.user_id, r.total_actions) for r in read_current(spark, scratch).collect()}
    assert got == {(1, 6), (2, 4)}


def test_ttl_is_relative_to_as_of(spark):
    rows = _rows(spark, [(1, T(2024, 1, 20), T(2024, 1, 20, 0, 5), 1, "total"),
                         (1, T(2024, 1, 24, 0, 0, 1), T(2024, 1, 24, 0, 5), 1, "total"),
                         (1, T(2024, 1, 24), T(2024, 1, 24, 0, 5), 1, "total")])
    kept = [r.window_start for r in expire_before(rows, "2024-01-31").collect()]
    assert kept == [T(2024, 1, 24, 0, 0, 1)]


def test_compaction_purges_expired_and_sorts_by_month(spark, scratch):
    ch, out = f"{scratch}/changes", f"{scratch}/compacted"
    write_changes(_rows(spark, [(1, T(2024, 1, 20), T(2024, 1, 20, 0, 5), 1, "total"),
                                (1, T(2024, 2, 1), T(2024, 2, 1, 0, 5), 2, "total")]), ch, 0)
    write_changes(_rows(spark, [(1, T(2024, 2, 1), T(2024, 2, 1, 0, 5), 5, "total")]), ch, 1)
    compact(read_changes(spark, ch), out, ttl_as_of="2024-02-03")
    got = [(r.yyyymm, r.total_actions) for r in spark.read.parquet(out).collect()]
    assert got == [(202402, 5)]


def test_lookup_adds_month_partition_filter(spark, scratch):
    ch, out = f"{scratch}/changes", f"{scratch}/compacted"
    write_changes(_rows(spark, [(8, T(2024, 1, 5, 2), T(2024, 1, 5, 4), 1, "total"),
                                (8, T(2024, 3, 5, 2), T(2024, 3, 5, 4), 1, "total")]), ch, 0)
    compact(read_changes(spark, ch), out)
    hit = lookup_aggregates(spark.read.parquet(out), 8, "total", "2024-01-05", "2024-01-06")
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert "yyyymm" in plan.split("PartitionFilters: [")[1].split("], ")[0]
    assert hit.count() == 1


def test_current_rows_drops_bookkeeping(spark):
    ch = spark.createDataFrame([(1, "total", T(2024, 1, 1), T(2024, 1, 1, 2), 3, T(2024, 1, 1), 0)],
                               "user_id long, aggregation_type string, window_start timestamp_ntz, "
                               "window_end timestamp_ntz, total_actions long, updated_at timestamp_ntz, "
                               "version long")
    assert "version" not in current_rows(ch).columns and "updated_at" not in current_rows(ch).columns


def test_reader_combines_compacted_table_with_newer_versions(spark, scratch):
    ch, out = f"{scratch}/changes", f"{scratch}/compacted"
    write_changes(_rows(spark, [(1, T(2024, 1, 1), T(2024, 1, 1, 2), 3, "total"),
                                (2, T(2024, 1, 1), T(2024, 1, 1, 2), 1, "total")]), ch, 0)
    assert compact_table(spark, ch, out) == covered(spark, out) == ["writer=main/version=0"]
    write_changes(_rows(spark, [(1, T(2024, 1, 1), T(2024, 1, 1, 2), 7, "total")]), ch, 1)
    cur = read_current(spark, ch, compacted=out)
    change_files = [f for f in cur.inputFiles() if "/changes/" in f]
    assert change_files and all("version=1" in f for f in change_files)
    assert {(r.user_id, r.total_actions) for r in cur.collect()} == {(1, 7), (2, 1)}
    assert {(r.user_id, r.total_actions) for r in read_current(spark, f"{scratch}/none", compacted=out)
            .collect()} == {(1, 3), (2, 1)}


def test_lookup_across_a_month_boundary(spark, scratch):
    ch, out = f"{scratch}/changes", f"{scratch}/compacted"
    write_changes(_rows(spark, [(8, T(2024, 1, 31, 22), T(2024, 2, 1), 1, "total"),
                                (8, T(2024, 2, 1, 0), T(2024, 2, 1, 2), 2, "total"),
                                (8, T(2024, 3, 1, 0), T(2024, 3, 1, 2), 3, "total")]), ch, 0)
    compact(read_changes(spark, ch), out)
    table = spark.read.parquet(out)
    both = lookup_aggregates(table, 8, "total", "2024-01-31", "2024-02-02")
    assert sorted(r.total_actions for r in both.collect()) == [1, 2]
    january = lookup_aggregates(table, 8, "total", "2024-01-31", "2024-02-01")
    part = january._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1]
    assert "202401" in part.split("], ")[0] and [r.total_actions for r in january.collect()] == [1]


def test_ttl_predicate_reaches_the_parquet_reader(spark, scratch):
    write_changes(_rows(spark, [(1, T(2024, 1, 20), T(2024, 1, 20, 0, 5), 1, "total")]), scratch, 0)
    plan = expire_before(read_changes(spark, scratch), "2024-01-31")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(window_start" in plan.split("PushedFilters: [")[1].split("], ")[0]


def test_incremental_compaction_starts_from_the_previous_one(spark, scratch):
    from actiontally.sources.changelog import changes_since

    ch, c1, c2 = f"{scratch}/changes", f"{scratch}/c1", f"{scratch}/c2"
    write_changes(_rows(spark, [(1, T(2024, 1, 1), T(2024, 1, 1, 2), 3, "total"),
                                (2, T(2024, 1, 1), T(2024, 1, 1, 2), 1, "total")]), ch, 0)
    compact_table(spark, ch, c1)
    write_changes(_rows(spark, [(1, T(2024, 1, 1), T(2024, 1, 1, 2), 7, "total"),
                                (3, T(2024, 2, 1), T(2024, 2, 1, 2), 2, "total")]), ch, 1)
    since = changes_since(spark, ch, c1)
    assert all("version=0" not in f for f in since.inputFiles())
    compact_table(spark, ch, c2, previous=c1)
    got = {(r.user_id, r.total_actions, r.version) for r in spark.read.parquet(c2).collect()}
    assert got == {(1, 7, 1), (2, 1, 0), (3, 2, 1)}
    assert covered(spark, c2) == ["writer=main/version=0", "writer=main/version=1"]
    assert remove_covered(spark, ch, c1) == ["writer=main/version=0"] and versions(spark, ch) == ["writer=main/version=1"]
    assert {r.total_actions for r in read_current(spark, ch, compacted=c2).collect()} == {7, 1, 2}


def test_a_version_being_written_is_neither_read_nor_covered(spark, scratch):
    ch, out = f"{scratch}/changes", f"{scratch}/c"
    row = lambda n: _rows(spark, [(n, T(2024, 1, 1), T(2024, 1, 1, 2), n, "total")])
    write_changes(row(1), ch, 0)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ch}/writer=main/version=1/_temporary")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    write_changes(row(3), ch, 2)
    compact_table(spark, ch, out)
    write_changes(row(2), ch, 1)  # it ends after the compaction has begun
    assert {r.user_id for r in read_current(spark, ch, compacted=out).collect()} == {1, 2, 3}


def test_writers_do_not_replace_each_other(spark, scratch):
    for n, writer in enumerate(("a", "b", "a")):
        write_changes(_rows(spark, [(n, T(2024, 1, 1), T(2024, 1, 1, 2), n, "total"), (9, T(2024, 1, 1), T(2024, 1, 1, 2), n, "total")]),
                      scratch, n // 2, writer=writer)
    got = {(r.user_id, r.total_actions) for r in read_current(spark, scratch).collect()}
    assert got == {(0, 0), (1, 1), (2, 2), (9, 2)}


def test_every_bound_prunes_months(spark, scratch):
    ch, out = f"{scratch}/changes", f"{scratch}/compacted"
    months = [(8, T(2024, m, 1), T(2024, m, 1, 2), m, "total") for m in range(1, 7)]
    write_changes(_rows(spark, months), ch, 0)
    compact_table(spark, ch, out)
    write_changes(_rows(spark, [(8, T(2024, 6, 1), T(2024, 6, 1, 2), 60, "total")]), ch, 1)
    current = read_current(spark, ch, compacted=out, keep_month=True)
    for table in (spark.read.parquet(out), current):
        for bounds, want in ((dict(start="2024-05-01"), 2), (dict(end="2024-03-01"), 2), (dict(start="2024-02-01", end="2024-04-01"), 2)):
            hit = lookup_aggregates(table, 8, "total", **bounds)
            plan = hit._jdf.queryExecution().executedPlan().toString()
            assert "PartitionFilters: [isnotnull(yyyymm" in plan and hit.count() == want
        assert lookup_aggregates(table, 8, "total", start="2024-03-01", end="2024-03-01").count() == 0


def test_change_log_records_follow_the_aggregate_contract(spark, scratch):
    from actiontally.schemas import AGGREGATE

    write_changes(_rows(spark, [(1, T(2024, 1, 1), T(2024, 1, 1, 2), 3, "total")]), scratch, 0)
    got = {f.name: f.dataType for f in read_changes(spark, scratch).schema.fields}
    assert got == {f.name: f.dataType for f in AGGREGATE.fields}
