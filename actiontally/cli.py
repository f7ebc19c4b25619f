"""Command line for ``spark-submit``: run the streams, backfill, curate, compact.

    spark-submit --py-files actiontally.zip actiontally/__main__.py stream --root <dir> --bootstrap host:9092
    spark-submit ... actiontally/__main__.py backfill --lake .../lake --table .../user_aggregations \\
        --start 2024-01-01 --end 2024-01-02
    spark-submit ... actiontally/__main__.py compact --table .../user_aggregations_realtime \\
        --out .../compacted/2024-01-31 --ttl-as-of 2024-01-31

``--root`` holds the lake, both aggregate tables and the stream checkpoints.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from actiontally.functions.decode import decode_events, split_corrupt
from actiontally.operators.backfill import backfill_to_table
from actiontally.operators.versions import compact_table, lookup_aggregates
from actiontally.session import build_session, pin_utc
from actiontally.sources.changelog import read_current, remove_covered, versions
from actiontally.sources.connectors import TOPIC, jdbc_exporter, read_topic
from actiontally.sources.slot_files import pack_slots
from actiontally.streaming.jobs import curate_slots, start_all


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="actiontally")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("stream", help="topic (or a directory of JSON text files) → lake + both tables")
    s.add_argument("--root", required=True)
    s.add_argument("--bootstrap")
    s.add_argument("--topic", default=TOPIC)
    s.add_argument("--json-dir", help="read JSON lines from files instead of a topic")
    s.add_argument("--trigger", default="5 minutes")
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--watermark", default="10 minutes")
    s.add_argument("--max-offsets", type=int)
    s.add_argument("--min-partitions", type=int)
    s.add_argument("--starting-offsets", default="earliest", help="where a new query starts in the topic")
    s.add_argument("--allow-data-loss", action="store_true", help="go on where records expired unread")
    s.add_argument("--dedup", action="store_true", help="count a repeated event_id once (all repeats land)")
    s.add_argument("--since", help="first window of a new checkpoint on tables that have rows")
    s.add_argument("--export-url", help="JDBC URL that also gets both tables' rows")
    s.add_argument("--export-2h", default="user_aggregations")
    s.add_argument("--export-5m", default="user_aggregations_realtime")
    s.add_argument("--state-partitions", type=int, help="fixed at the first start of a checkpoint")
    s.add_argument("--output-files", type=int, help="files per change-log version")
    s.add_argument("--bucket-dirs", action="store_true", help="lake with bucket directories")
    s.add_argument("--aggregates-from", choices=["source", "lake"], default="lake",
                   help="feed the aggregates from the landing lake: one JSON parse per record")
    b = sub.add_parser("backfill", help="recompute [start, end) of the 2-hour table from the lake")
    b.add_argument("--lake", required=True)
    b.add_argument("--table", required=True)
    b.add_argument("--start", required=True)
    b.add_argument("--end", required=True)
    b.add_argument("--dedup", action="store_true", help="count a repeated event_id once")
    c = sub.add_parser("curate", help="rewrite closed slots of the landing lake sorted")
    c.add_argument("--landing", required=True)
    c.add_argument("--lake", required=True)
    c.add_argument("--start", required=True)
    c.add_argument("--end", required=True)
    c.add_argument("--bucket-dirs", action="store_true", help="the lake has bucket directories")
    c.add_argument("--dedup", action="store_true", help="keep one event of each event_id")
    pk = sub.add_parser("pack", help="rewrite closed slots of the landing lake as few files of a wanted size")
    pk.add_argument("--landing", required=True)
    pk.add_argument("--lake", required=True)
    pk.add_argument("--start", required=True)
    pk.add_argument("--end", required=True)
    pk.add_argument("--target-mb", type=int, default=256)
    k = sub.add_parser("compact", help="collapse a table's versions into month partitions")
    k.add_argument("--table", required=True)
    k.add_argument("--out", required=True)
    k.add_argument("--ttl-as-of")
    k.add_argument("--ttl", default="7 days")
    k.add_argument("--previous", help="last compaction of this table: start from it, not from the history")
    k.add_argument("--remove", action="store_true", help="delete the versions that --previous covers")
    lk = sub.add_parser("lookup", help="rows of one user from a table, by aggregation type and window range")
    lk.add_argument("--table", required=True, help="a compacted table or a change log")
    lk.add_argument("--user", type=int, required=True)
    lk.add_argument("--type", default=None, help="aggregation_type, e.g. total or action:search")
    lk.add_argument("--start", required=True)
    lk.add_argument("--end", required=True)
    lk.add_argument("--compacted", help="with a change log: its last compaction")
    lk.add_argument("--out", help="write the rows there (JSON lines) instead of printing them")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or build_session(app=f"actiontally-{args.cmd}")
    pin_utc(spark)
    if args.cmd == "stream":
        if args.json_dir:
            raw = spark.readStream.schema("value string").text(args.json_dir)
        else:
            raw = read_topic(spark, args.bootstrap, args.topic, args.starting_offsets, not args.allow_data_loss,
                             max_offsets_per_trigger=args.max_offsets, min_partitions=args.min_partitions)
        events, rejects = split_corrupt(decode_events(raw))
        trigger = {"availableNow": True} if args.available_now else {"processingTime": args.trigger}
        export = {}
        if args.export_url:
            export = {"export_2h": jdbc_exporter(args.export_url, args.export_2h),
                      "export_5m": jdbc_exporter(args.export_url, args.export_5m)}
        queries = start_all(events, args.root, trigger, args.watermark, rejects, args.bucket_dirs, dedup=args.dedup,
                            state_partitions=args.state_partitions, output_files=args.output_files,
                            since=args.since, aggregates_from=args.aggregates_from, **export)
        if args.available_now:
            for q in queries.values():
                q.awaitTermination()
        else:
            spark.streams.awaitAnyTermination()
        return {"queries": sorted(queries)}
    if args.cmd == "backfill":
        return {"writer": backfill_to_table(spark, args.lake, args.table, args.start, args.end, dedup=args.dedup)}
    if args.cmd == "lookup":
        if args.compacted:
            table = read_current(spark, args.table, compacted=args.compacted, keep_month=True)
        elif versions(spark, args.table):  # a change log, not a compaction: collapse it
            table = read_current(spark, args.table)
        else:
            table = spark.read.parquet(args.table)
        hits = lookup_aggregates(table, args.user, args.type, args.start, args.end)
        hits = hits.orderBy("window_start", "aggregation_type")
        if args.out:
            hits.write.mode("overwrite").json(args.out)
            return {"out": args.out}
        n = 0
        for r in hits.toLocalIterator():
            print({k: str(v) for k, v in r.asDict().items()})
            n += 1
        return {"rows": n}
    if args.cmd == "curate":
        curate_slots(spark, args.landing, args.lake, args.start, args.end, bucket_dirs=args.bucket_dirs, dedup=args.dedup)
        return {"lake": args.lake}
    if args.cmd == "pack":
        return {"lake": args.lake, "tasks": pack_slots(spark, args.landing, args.lake, args.start, args.end, args.target_mb << 20)}
    which = compact_table(spark, args.table, args.out, args.previous, args.ttl_as_of, args.ttl)
    removed = remove_covered(spark, args.table, args.previous) if args.remove and args.previous else []
    return {"out": args.out, "covered": which, "removed": removed}
