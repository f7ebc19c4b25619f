"""The spark-submit entry point, run in-process on the test session."""

from __future__ import annotations

from pyspark.sql import functions as F

from actiontally.cli import main
from actiontally.operators.aggregates import user_action_counts, user_aggregations
from actiontally.plans.fixtures import json_envelope, plain_events
from actiontally.sources.changelog import read_current, versions
from actiontally.sources.lake import read_lake

SF = "/root/testdata/sf0.001"


def test_stream_then_curate_backfill_compact(spark, scratch):
    json_envelope(spark, SF).write.text(f"{scratch}/topic")
    root = f"{scratch}/root"
    main(["stream", "--root", root, "--json-dir", f"{scratch}/topic", "--available-now"], spark)
    base = plain_events(spark, SF)
    assert read_lake(spark, f"{root}/lake").count() == base.count()

    main(["curate", "--landing", f"{root}/lake", "--lake", f"{scratch}/lake",
          "--start", "2024-01-01", "--end", "2024-02-01"], spark)
    assert read_lake(spark, f"{scratch}/lake").count() == base.count()
    assert main(["pack", "--landing", f"{root}/lake", "--lake", f"{scratch}/packed",
                 "--start", "2024-01-01", "--end", "2024-02-01"], spark)["tasks"] == 1
    assert read_lake(spark, f"{scratch}/packed").count() == base.count()

    out = main(["backfill", "--lake", f"{scratch}/lake", "--table", f"{root}/user_aggregations",
                "--start", "2024-01-01", "--end", "2024-02-01"], spark)
    assert any(v.startswith(f"writer={out['writer']}/") for v in versions(spark, f"{root}/user_aggregations"))
    want = user_aggregations(base, time_col="ts", type_col="event_type")
    got = read_current(spark, f"{root}/user_aggregations").select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0

    main(["compact", "--table", f"{root}/user_aggregations_realtime", "--out", f"{scratch}/rt",
          "--ttl-as-of", "2024-01-31"], spark)
    five = user_action_counts(base, "5 minutes", time_col="ts")
    kept = five.filter(F.col("window_start") > F.lit("2024-01-24").cast("timestamp_ntz"))
    assert spark.read.parquet(f"{scratch}/rt").count() == kept.count()


def test_readme_example_runs(spark, scratch):
    from actiontally.functions import decode_events, family_payload, split_corrupt
    from actiontally.operators import compact_table, lookup_aggregates
    from actiontally.sources import lake_scan, write_lake
    from actiontally.streaming import start_all

    json_envelope(spark, SF).write.text(f"{scratch}/raw")
    events, rejected = split_corrupt(decode_events(spark.read.text(f"{scratch}/raw")))
    assert rejected.count() == 0
    assert user_aggregations(events).count() == user_aggregations(
        plain_events(spark, SF), time_col="ts", type_col="event_type").count()
    assert family_payload(events, "product").count() == 0  # the F-B envelope carries {"k": n} only
    write_lake(events, f"{scratch}/lake")
    week = lake_scan(spark, f"{scratch}/lake", user_id=8, start="2024-01-05", end="2024-01-12")
    assert week.count() == plain_events(spark, SF).filter(
        "user_id = 8 and ts >= '2024-01-05' and ts < '2024-01-12'").count()
    raw = spark.readStream.schema("value string").text(f"{scratch}/raw")
    for q in start_all(split_corrupt(decode_events(raw))[0], f"{scratch}/actions",
                       trigger={"availableNow": True}, state_partitions=4).values():
        q.awaitTermination()
    t = f"{scratch}/actions/user_aggregations_realtime"
    compact_table(spark, t, f"{scratch}/c", ttl_as_of="2024-01-31")
    current = read_current(spark, t, compacted=f"{scratch}/c")
    assert current.count() == spark.read.parquet(f"{scratch}/c").count()
    hits = lookup_aggregates(spark.read.parquet(f"{scratch}/c"), 8, "total", "2024-01-24", "2024-02-01")
    assert hits.count() >= 0


def test_lookup_command(spark, scratch):
    base = plain_events(spark, SF)
    table, out = f"{scratch}/t", f"{scratch}/c"
    from actiontally.sources.changelog import write_changes

    write_changes(user_aggregations(base, time_col="ts", type_col="event_type"), table, 0)
    main(["compact", "--table", table, "--out", out], spark)
    want = user_aggregations(base, time_col="ts", type_col="event_type").filter(
        "user_id = 8 and aggregation_type = 'total' and window_start >= '2024-01-05' and window_start < '2024-01-12'")
    for t in [out, table]:
        args = ["lookup", "--table", t, "--user", "8", "--type", "total", "--start", "2024-01-05", "--end", "2024-01-12"]
        assert main(args, spark)["rows"] == want.count()
        main([*args, "--out", f"{t}-hits"], spark)
        assert sorted(r.total_actions for r in spark.read.json(f"{t}-hits").collect()) == sorted(r.total_actions for r in want.collect())


def test_stream_command_feeding_aggregates_from_the_lake(spark, scratch):
    json_envelope(spark, SF).write.text(f"{scratch}/topic")
    root = f"{scratch}/root"
    args = ["stream", "--root", root, "--json-dir", f"{scratch}/topic", "--available-now",
            "--aggregates-from", "lake", "--state-partitions", "4", "--output-files", "1"]
    main(args, spark)
    base = plain_events(spark, SF)
    want = user_action_counts(base, "5 minutes", time_col="ts")
    got = read_current(spark, f"{root}/user_aggregations_realtime").select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
