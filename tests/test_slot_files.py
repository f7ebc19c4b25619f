"""Packing of landing files: files bounded by bytes, rows unchanged."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from actiontally.plans.fixtures import plain_events
from actiontally.sources.lake import check_layout, lake_scan
from actiontally.sources.slot_files import fill_tasks, pack_slots, slot_files
from actiontally.streaming.jobs import lake_stream, landing_stream, run_to_completion

T = dt.datetime
DAYS = ("2024-01-01", "2024-01-03")
EVENT = "event_id long, user_id long, event_time timestamp_ntz, note string"


def _event(i: int, hot: bool = True):
    user = None if i % 97 == 0 else 7 if hot and i % 3 == 0 else i % 211
    return i, user, T(2024, 1, 1) + dt.timedelta(minutes=(i * 7) % 240), f"{i * 2654435761 % 2**32:08x}" * 6


def _landing(spark, path, rows, files=6):
    """A landing lake with ``files`` files in each slot."""
    check_layout(spark, path, False)
    from actiontally.functions.layout import with_partition_columns

    with_partition_columns(spark.createDataFrame(rows, EVENT)).repartition(files).write.mode("append").partitionBy("event_date", "event_hour").parquet(path)


def _listing(df):
    return {(r.event_date, r.event_hour): (r.files, r.bytes) for r in slot_files(df).collect()}


def _rows(df):
    return sorted((tuple(r) for r in df.select("event_id", "user_id", "event_time", "note", "bucket", "event_date", "event_hour").collect()), key=str)


@given(st.lists(st.integers(0, 1000), max_size=40), st.integers(1, 300))
def test_tasks_are_filled_to_the_target(sizes, target):
    slots = [(dt.date(2024, 1, 1) + dt.timedelta(days=i // 12), i % 12 * 2, s) for i, s in enumerate(sizes)]
    held: dict[int, int] = {}
    for (_, _, size), (_, _, pieces, first) in zip(slots, fill_tasks(slots, target)):
        assert pieces == max(1, math.ceil(size / target))
        if pieces > 1:
            assert not held.keys() & set(range(first, first + pieces))
            held |= dict.fromkeys(range(first, first + pieces), target)
        else:
            held[first] = held.get(first, 0) + size
    assert sorted(held) == list(range(len(held)))
    assert all(v <= target for v in held.values())


@given(st.lists(st.integers(0, 1000), max_size=40), st.integers(1, 300), st.integers(1, 300))
def test_slots_that_share_a_task_are_few(sizes, target, shared):
    slots = [(dt.date(2024, 1, 1) + dt.timedelta(days=i // 12), i % 12 * 2, s) for i, s in enumerate(sizes)]
    held: dict[int, list[int]] = {}
    for (_, _, size), (_, _, pieces, first) in zip(slots, fill_tasks(slots, target, shared)):
        assert pieces == max(1, math.ceil(size / target))
        for task in range(first, first + pieces):
            held.setdefault(task, []).append(size if pieces == 1 else target)
    assert sorted(held) == list(range(len(held)))
    assert all(len(v) == 1 or sum(v) <= min(shared, target) for v in held.values())


def test_a_task_holds_few_bytes_however_large_the_files_may_be(spark, scratch, monkeypatch):
    """Many slots far below a file's wanted size: one file each, from more than one task."""
    landing, lake = f"{scratch}/landing", f"{scratch}/lake"
    rows = [(i, i % 50, T(2024, 1, 1) + dt.timedelta(minutes=i * 7 % 2880), "n") for i in range(3000)]
    _landing(spark, landing, rows)
    before = _listing(lake_scan(spark, landing, start=DAYS[0], end=DAYS[1]))
    monkeypatch.setitem(pack_slots.__globals__, "SHARED_BYTES", 3 * max(b for _, b in before.values()))
    tasks = pack_slots(spark, landing, lake, *DAYS)
    packed = lake_scan(spark, lake, start=DAYS[0], end=DAYS[1])
    assert 8 <= tasks < len(before) == 24
    assert {n for n, _ in _listing(packed).values()} == {1}
    assert _rows(packed) == _rows(lake_scan(spark, landing, start=DAYS[0], end=DAYS[1]))


@pytest.mark.parametrize("share", [2.0, 0.2])
def test_files_of_a_slot_are_bounded_by_bytes(spark, scratch, share):
    landing, lake = f"{scratch}/landing", f"{scratch}/lake"
    _landing(spark, landing, [_event(i) for i in range(6000)])
    before = _listing(lake_scan(spark, landing, start=DAYS[0], end=DAYS[1]))
    assert len(before) == 2 and all(n == 6 for n, _ in before.values())
    target = int(max(b for _, b in before.values()) * share)
    tasks = pack_slots(spark, landing, lake, *DAYS, target_bytes=target)
    packed = lake_scan(spark, lake, start=DAYS[0], end=DAYS[1])
    after = _listing(packed)
    assert {k: n for k, (n, _) in after.items()} == {k: math.ceil(b / target) for k, (_, b) in before.items()}
    assert tasks == (1 if share > 1 else sum(n for n, _ in after.values()))
    assert _rows(packed) == _rows(lake_scan(spark, landing))
    if share < 1:  # pieces of like size, a user but the hot one in two at most
        sizes = packed.groupBy("event_date", "event_hour", F.col("_metadata.file_path").alias("f")).count().collect()
        assert max(r["count"] for r in sizes) < 2 * min(r["count"] for r in sizes)
        spread = packed.groupBy("event_hour", "user_id").agg(F.countDistinct("_metadata.file_path").alias("n"))
        assert spread.filter("n > 2 and user_id <> 7").count() == 0
        assert spread.filter("user_id = 7").agg(F.min("n")).first()[0] >= 2
    hit = lake_scan(spark, lake, user_id=7, start="2024-01-01", end="2024-01-02")
    assert hit.count() == sum(_event(i)[1] == 7 for i in range(6000))


def test_packing_again_replaces_the_same_slots(spark, scratch):
    landing, lake = f"{scratch}/landing", f"{scratch}/lake"
    _landing(spark, landing, [_event(i) for i in range(300)])
    pack_slots(spark, landing, lake, "2024-01-01 00:00:00", "2024-01-01 02:00:00")
    first = _rows(lake_scan(spark, lake))
    _landing(spark, landing, [_event(5), _event(300), _event(5)])
    pack_slots(spark, landing, lake, "2024-01-01 02:00:00", "2024-01-01 04:00:00")
    assert all(r in _rows(lake_scan(spark, lake)) for r in first)
    for _ in range(2):
        pack_slots(spark, landing, lake, *DAYS)
        assert _rows(lake_scan(spark, lake)) == _rows(lake_scan(spark, landing))


def test_packing_of_nothing_and_of_odd_ranges(spark, scratch):
    landing, lake = f"{scratch}/landing", f"{scratch}/lake"
    _landing(spark, landing, [_event(i) for i in range(30)])
    assert pack_slots(spark, landing, lake, "2025-01-01", "2025-01-02") == 0
    with pytest.raises(ValueError, match="slot bound"):
        pack_slots(spark, landing, lake, "2024-01-01 01:00:00", "2024-01-02")
    with pytest.raises(ValueError, match="positive"):
        pack_slots(spark, landing, lake, *DAYS, target_bytes=0)


def test_what_a_stream_landed_is_packed(spark, scratch):
    from actiontally.functions.decode import decode_events, encode_json
    from actiontally.plans.fixtures import envelope_fields

    src, days = f"{scratch}/in", ("2024-01-05", "2024-01-07")
    e = plain_events(spark, "/root/testdata/sf0.001").filter("ts >= '2024-01-05' and ts < '2024-01-07'")
    encode_json(e, envelope_fields(), key="event_id").select("value").repartition(8).write.text(src)
    decoded = decode_events(spark.readStream.schema("value string").text(src))
    ids = lambda df: sorted(r[0] for r in df.select("event_id").collect())
    for name, start, rows in (("both", landing_stream, decoded), ("lake", lake_stream, decoded.drop("_corrupt"))):
        landing, lake = f"{scratch}/{name}", f"{scratch}/{name}-packed"
        run_to_completion(start(rows, landing, f"{scratch}/{name}-ck", {"availableNow": True}))
        want = lake_scan(spark, landing, start=days[0], end=days[1])
        assert max(n for n, _ in _listing(want).values()) > 1
        pack_slots(spark, landing, lake, *days)
        got = lake_scan(spark, lake, start=days[0], end=days[1])
        assert {n for n, _ in _listing(got).values()} == {1}
        assert ids(got) == ids(want) == sorted(f"evt-{i}" for i in ids(e))
