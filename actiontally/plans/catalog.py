"""Registered queries: one per operator of the inventory, each over whole driver tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame.  Queries that go
through storage (lake, change log, compacted table, streams) first write under a
fresh directory below ``spark.checkpoint.dir`` and return a lazy read of the result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actiontally.functions.decode import (
    decode_events, device_info_flat, encode_json, family_payload, open_payload, payload_keys, split_corrupt,
)
from actiontally.functions.layout import with_partition_columns
from actiontally.operators.aggregates import user_action_counts, user_aggregations
from actiontally.operators.backfill import backfill_aggregations
from actiontally.operators.backfill import backfill_to_table, repair_slots
from actiontally.operators.versions import (
    compact_table, expire_before, latest_versions, lookup_aggregates, month_summary,
)
from actiontally.plans.fixtures import (
    envelope_fields, family_envelope, json_envelope, open_envelope, order_events, plain_events,
)
from actiontally.session import pin_utc, scratch_path
from actiontally.sources.changelog import read_changes, read_current, remove_covered, user_splits, write_changes
from actiontally.sources.lake import lake_scan, read_lake, read_landed, write_lake
from actiontally.sources.slot_files import TARGET_BYTES, pack_slots, slot_files
from actiontally.streaming.jobs import (
    aggregate_stream, chained_window_stream, closed_window_stream, curate_slots, open_windows, run_to_completion, start_all, start_fan_out,
)
from actiontally.streaming.staging import file_stream, replay_slices, undo_last_commit

AGG_COLS = ["user_id", "window_start", "window_end", "total_actions", "aggregation_type"]
COUNT_COLS = ["user_id", "window_start", "window_end", "total_actions"]
EV = dict(time_col="ts", type_col="event_type")

# Parameters of the checked lookups and expiry (fixed so the oracle can state them).
LOOKUP_USER = 8
LOOKUP_EVENT = 77
LAKE_LOOKUP = ("2024-01-05 03:00:00", "2024-01-09 05:00:00")
AGG_LOOKUP = ("2024-01-05 00:00:00", "2024-01-06 00:00:00")
TTL_AS_OF = "2024-01-31 00:00:00"
VERSION_CUTOFFS = ["2024-01-10", "2024-01-20", None]  # None: all events
BACKFILL_RANGE = ("2024-01-10 00:00:00", "2024-01-12 00:00:00")
REPAIR_RANGE = ("2024-01-01 00:00:00", "2024-01-31 00:00:00")
SEED_CUTOFF = "2024-01-20 13:07:00"


# --- aggregates -------------------------------------------------------------------------

def user_actions_2h(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return user_action_counts(plain_events(spark, sf_dir), "2 hours", **EV)


def user_action_types_2h(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return user_action_counts(plain_events(spark, sf_dir), "2 hours", by_type=True, **EV)


def user_actions_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return user_action_counts(plain_events(spark, sf_dir), "5 minutes", **EV)


def user_aggregations_2h(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return user_aggregations(plain_events(spark, sf_dir), "2 hours", **EV).select(*AGG_COLS)


# --- decode / encode --------------------------------------------------------------------

def decode_events_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    good, _ = split_corrupt(decode_events(json_envelope(spark, sf_dir)))
    return good.select("event_id", "user_id", "action_type", "event_time",
                       F.from_json("metadata", "k int").getField("k").alias("k"),
                       "device_info.device_type", "device_info.os_version", "device_info.app_version")


def device_info_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    good, _ = split_corrupt(decode_events(json_envelope(spark, sf_dir)))
    return device_info_flat(good, keep=("event_id",))


def _family(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pin_utc(spark)
        good, _ = split_corrupt(decode_events(family_envelope(spark, sf_dir)))
        return family_payload(good, name)
    run.__name__ = f"metadata_{name}"
    return run


#: Payload keys outside the six families, by path and wanted type.
OPEN_FIELDS = {"k": ("$.k", "int"), "coupon": ("$.coupon", "string"), "score": ("$.score", "int"), "depth": ("$.nav.depth", "int"), "tag": ("$.tags[0]", "string")}


def metadata_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of no family: keys that may be absent, mistyped, nested or in a list."""
    good, _ = split_corrupt(decode_events(open_envelope(spark, sf_dir)))
    return open_payload(good, OPEN_FIELDS)


def metadata_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which keys those payloads carry per action type, and as what."""
    good, _ = split_corrupt(decode_events(open_envelope(spark, sf_dir)))
    return payload_keys(good)


def encode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full six-field record, published as text and decoded back."""
    pin_utc(spark)
    text = encode_json(plain_events(spark, sf_dir), envelope_fields())
    good, _ = split_corrupt(decode_events(text))
    return good.select("event_id", "user_id", "action_type", "event_time",
                       F.from_json("metadata", "k int").getField("k").alias("k"),
                       "device_info.device_id", "device_info.device_type", "device_info.os_version", "device_info.app_version")


# --- lake -------------------------------------------------------------------------------

def partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return with_partition_columns(plain_events(spark, sf_dir), time_col="ts") \
        .select("event_id", "event_date", "event_hour", "bucket")


def _landed_lake(spark: SparkSession, sf_dir: str) -> str:
    pin_utc(spark)
    path = scratch_path(spark, "lake")
    write_lake(plain_events(spark, sf_dir), path, time_col="ts")
    return path


def lake_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = read_lake(spark, _landed_lake(spark, sf_dir))
    return lake.select("event_id", "ts", "user_id", "event_type", "value", "props",
                       "event_date", "event_hour", "bucket")


def lake_event_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event by its id, in a lake whose files have Bloom filters of ids and users."""
    pin_utc(spark)
    path = scratch_path(spark, "lake")
    write_lake(plain_events(spark, sf_dir), path, time_col="ts", bloom=("event_id", "user_id"))
    return read_lake(spark, path).filter(F.col("event_id") == LOOKUP_EVENT).select("event_id", "ts", "user_id", "event_type")


def lake_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = read_lake(spark, _landed_lake(spark, sf_dir))
    return lake.groupBy("event_date", "event_hour", "bucket").agg(F.count(F.lit(1)).alias("n_events"))


def lake_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed_lake(spark, sf_dir)
    return lake_scan(spark, path, user_id=LOOKUP_USER, start=LAKE_LOOKUP[0], end=LAKE_LOOKUP[1],
                     time_col="ts").select("event_id", "ts", "event_type")


def lake_bucket_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table landed, two closed days of it curated into a lake with all three directory
    levels (128 buckets): rows per leaf, named as the directories are."""
    path = scratch_path(spark, "bucket_lake")
    curate_slots(spark, _landed_lake(spark, sf_dir), path, *BACKFILL_RANGE, time_col="ts", bucket_dirs=True)
    leaf = F.regexp_extract(F.input_file_name(), "event_date=[^/]+/event_hour=[^/]+/bucket=[^/]+", 0)
    return spark.read.parquet(path).select(leaf.alias("leaf")).groupBy("leaf").agg(F.count(F.lit(1)).alias("n_events"))


def lake_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table landed and packed: events per slot, the sum of their ids, and whether the slot has
    no more files than its landed bytes need."""
    landing, path = _landed_lake(spark, sf_dir), scratch_path(spark, "packed_lake")
    first, last = plain_events(spark, sf_dir).agg(F.min("ts"), F.max("ts")).first()
    end = last.replace(hour=0, minute=0, second=0, microsecond=0) + dt.timedelta(days=1)
    pack_slots(spark, landing, path, first.replace(hour=0, minute=0, second=0, microsecond=0), end, time_col="ts")
    slot, lake = ["event_date", "event_hour"], read_lake(spark, path)
    rows = lake.groupBy(*slot).agg(F.count(F.lit(1)).alias("n_events"), F.sum("event_id").alias("id_sum"))
    landed = slot_files(read_lake(spark, landing)).select(*slot, F.ceil(F.col("bytes") / F.lit(TARGET_BYTES)).alias("most"))
    files = slot_files(lake).select(*slot, "files")
    each = rows.unionByName(files, True).unionByName(landed, True).groupBy(*slot).agg(*(F.max(c).alias(c) for c in ("n_events", "id_sum", "files", "most")))
    return each.select(*slot, "n_events", "id_sum", (F.col("files") <= F.col("most")).alias("bounded")).filter(
        "event_date is not null and event_hour is not null and n_events is not null and bounded is not null")


def lake_backfill_2h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals and per-type counts recomputed from the lake's slots."""
    lake = read_lake(spark, _landed_lake(spark, sf_dir))
    return backfill_aggregations(lake, type_col="event_type").select(*AGG_COLS)


# --- versioned aggregate tables ---------------------------------------------------------

def agg_latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three versions of the 2-hour totals as the table grew (events before 01-10, before
    01-20, then all of them); the newest version of every key wins."""
    pin_utc(spark)
    e = plain_events(spark, sf_dir)
    table_path = scratch_path(spark, "user_aggregations")
    for version, cutoff in enumerate(VERSION_CUTOFFS):
        known = e if cutoff is None else e.filter(F.col("ts") < F.lit(cutoff).cast("timestamp_ntz"))
        rows = user_action_counts(known, "2 hours", **EV)
        write_changes(rows.withColumn("aggregation_type", F.lit("total")), table_path, version)
    cur = latest_versions(read_changes(spark, table_path))
    return cur.select("user_id", "window_start", "window_end", "total_actions", "version")


def _aggregate_versions(spark: SparkSession, events: DataFrame, type_col: str, time_col: str) -> str:
    """Two versions of the 2-hour table: one of the mornings only, then the full one."""
    table_path = scratch_path(spark, "user_aggregations")
    for version, rows in enumerate((events.filter(F.hour(time_col) < 12), events)):
        write_changes(user_aggregations(rows, "2 hours", time_col=time_col, type_col=type_col), table_path, version)
    return table_path


def _compacted_table(spark: SparkSession, events: DataFrame, type_col: str, time_col: str) -> str:
    """Both versions compacted into month partitions sorted by key."""
    out = scratch_path(spark, "user_aggregations_compacted")
    compact_table(spark, _aggregate_versions(spark, events, type_col, time_col), out)
    return out


def agg_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    out = _compacted_table(spark, plain_events(spark, sf_dir), "event_type", "ts")
    return spark.read.parquet(out).select(*AGG_COLS)


def agg_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    out = _compacted_table(spark, plain_events(spark, sf_dir), "event_type", "ts")
    hit = lookup_aggregates(spark.read.parquet(out), user_id=LOOKUP_USER, aggregation_type="total",
                            start=AGG_LOOKUP[0], end=AGG_LOOKUP[1], splits=user_splits(spark, out))
    return hit.select("user_id", "window_start", "total_actions")


def agg_month_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month partitions of the 2-hour table over ``orders`` (80 months)."""
    pin_utc(spark)
    out = _compacted_table(spark, order_events(spark, sf_dir), "action_type", "event_time")
    return month_summary(spark.read.parquet(out))


def agg_current_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One user's totals from a compaction of an early version and the version after it."""
    pin_utc(spark)
    e = plain_events(spark, sf_dir)
    table_path, out = scratch_path(spark, "user_aggregations"), scratch_path(spark, "user_aggregations_compacted")
    write_changes(user_aggregations(e.filter(F.hour("ts") < 12), "2 hours", **EV), table_path, 0)
    compact_table(spark, table_path, out)
    write_changes(user_aggregations(e, "2 hours", **EV), table_path, 1)
    hit = lookup_aggregates(read_current(spark, table_path, compacted=out, keep_month=True), user_id=LOOKUP_USER,
                            aggregation_type="total", start=AGG_LOOKUP[0], splits=user_splits(spark, out))
    return hit.select("user_id", "window_start", "total_actions")


def agg_backfill_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over the whole table, a backfill of two days whose lake holds every event
    twice, then the stream once more: the backfilled slots keep the backfill's counts."""
    pin_utc(spark)
    e = plain_events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type")
    table_path, ckpt, src, lake = (scratch_path(spark, n) for n in ("user_aggregations", "ckpt", "stream_input", "lake"))

    def start():
        return aggregate_stream(file_stream(spark, src, e.schema), table_path, ckpt, "2 hours", True,
                                trigger={"availableNow": True}, state_partitions=_cores(spark), **EV)

    replay_slices(e, src, "ts", start, n_slices=1)
    write_lake(e.union(e), lake, time_col="ts")
    backfill_to_table(spark, lake, table_path, *BACKFILL_RANGE, time_col="ts", type_col="event_type")
    last = e.agg(F.max("ts").alias("ts"))
    again = last.select(F.lit(-1).cast("bigint").alias("event_id"), (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"),
                        F.lit(-1).cast("bigint").alias("user_id"), F.lit("login").alias("event_type"))
    replay_slices(again, src, "ts", start, n_slices=1)
    return read_current(spark, table_path).filter("user_id >= 0").select(*AGG_COLS)


def _stream_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return plain_events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type")


def _fed(spark: SparkSession, rows: DataFrame, src: str, table_path: str, ckpt: str, slices: int = 1, **how) -> None:
    """Feed rows, in slices by time, to the 2-hour stream of a table."""
    schema = rows.schema
    replay_slices(rows, src, "ts", lambda: aggregate_stream(file_stream(spark, src, schema), table_path, ckpt, "2 hours", True,
                                                            trigger={"availableNow": True}, state_partitions=_cores(spark), **EV, **how), slices)


def agg_replay_after_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over the whole table, a backfill of two days whose lake holds every event twice, then
    the stream's last batch once more, as after a crash ahead of its commit: the backfill stays."""
    e = _stream_source(spark, sf_dir)
    table_path, ckpt, src, lake = (scratch_path(spark, n) for n in ("user_aggregations", "ckpt", "stream_input", "lake"))
    _fed(spark, e, src, table_path, ckpt)
    write_lake(e.union(e), lake, time_col="ts")
    backfill_to_table(spark, lake, table_path, *BACKFILL_RANGE, time_col="ts", type_col="event_type")
    undo_last_commit(spark, ckpt)
    run_to_completion(lambda: aggregate_stream(file_stream(spark, src, e.schema), table_path, ckpt, "2 hours", True,
                                               trigger={"availableNow": True}, state_partitions=_cores(spark), **EV))
    return read_current(spark, table_path).select(*AGG_COLS)


def stream_seeded_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream up to the middle of a window, a compaction whose versions are removed, and a new
    checkpoint over the rest, seeded with the table's open windows."""
    e = _stream_source(spark, sf_dir)
    table_path, out = scratch_path(spark, "user_aggregations"), scratch_path(spark, "user_aggregations_compacted")
    cut = F.col("ts") < F.lit(SEED_CUTOFF).cast("timestamp_ntz")
    _fed(spark, e.filter(cut), scratch_path(spark, "stream_input"), table_path, scratch_path(spark, "ckpt"), 2)
    compact_table(spark, table_path, out)
    remove_covered(spark, table_path, out)
    _fed(spark, e.filter(~cut), scratch_path(spark, "stream_input"), table_path, scratch_path(spark, "ckpt"), 2,
         seed=read_current(spark, table_path, compacted=out))
    return read_current(spark, table_path, compacted=out).select(*AGG_COLS)


def late_slot_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the first three weeks' events reaches the stream after everything else, and is dropped by the
    watermark; the lake has all. The slots they changed are found by digest and recomputed."""
    e = _stream_source(spark, sf_dir)
    table_path, ckpt, src, lake = (scratch_path(spark, n) for n in ("user_aggregations", "ckpt", "stream_input", "lake"))
    late = (F.col("event_id") % 10 == 0) & (F.col("ts") < F.lit("2024-01-22").cast("timestamp_ntz"))
    _fed(spark, e.filter(~late), src, table_path, ckpt, 2)
    _fed(spark, e.filter(late), src, table_path, ckpt)
    write_lake(e, lake, time_col="ts")
    repair_slots(spark, lake, table_path, *REPAIR_RANGE, time_col="ts", type_col="event_type")
    return read_current(spark, table_path).select(*AGG_COLS)


def realtime_ttl_7d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5-minute table's live rows, read from a compaction that expired the others."""
    pin_utc(spark)
    table_path = scratch_path(spark, "user_aggregations_realtime")
    rows = user_action_counts(plain_events(spark, sf_dir), "5 minutes", **EV)
    write_changes(rows.withColumn("aggregation_type", F.lit("total")), table_path, 0)
    out = scratch_path(spark, "user_aggregations_realtime_compacted")
    compact_table(spark, table_path, out, ttl_as_of=TTL_AS_OF)
    return expire_before(read_current(spark, table_path, compacted=out), TTL_AS_OF).select(*COUNT_COLS)


# --- streams ----------------------------------------------------------------------------

def _cores(spark: SparkSession) -> int:
    """State partitions for the replayed streams: one per core of the cluster."""
    try:
        return max(1, spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - no SparkContext on a remote session
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _replayed(spark: SparkSession, sf_dir: str, start, replay_first: bool = False) -> None:
    """Feed ``events`` to the stream ``start(source)`` in six event-time slices, one
    micro-batch each."""
    pin_utc(spark)
    src = plain_events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type")
    source = scratch_path(spark, "stream_input")
    replay_slices(src, source, "ts", lambda: start(file_stream(spark, source, src.schema)), 6, replay_first)


def stream_user_aggregations_2h(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_path, ckpt = scratch_path(spark, "user_aggregations"), scratch_path(spark, "ckpt")
    _replayed(spark, sf_dir, lambda s: aggregate_stream(s, table_path, ckpt, "2 hours", True,
                                                        trigger={"availableNow": True},
                                                        state_partitions=_cores(spark), **EV))
    return read_current(spark, table_path).select(*AGG_COLS)


def stream_user_actions_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_path, ckpt = scratch_path(spark, "user_aggregations_realtime"), scratch_path(spark, "ckpt")
    _replayed(spark, sf_dir, lambda s: aggregate_stream(s, table_path, ckpt, "5 minutes", False,
                                                        trigger={"availableNow": True},
                                                        state_partitions=_cores(spark), **EV))
    return read_current(spark, table_path).select(*COUNT_COLS)


def _closed_windows(spark: SparkSession, sf_dir: str, replay_first: bool) -> DataFrame:
    out, ckpt = scratch_path(spark, "closed_windows"), scratch_path(spark, "ckpt")
    _replayed(spark, sf_dir, lambda s: closed_window_stream(s, out, ckpt, "2 hours", trigger={"availableNow": True},
                                                            time_col="ts", state_partitions=_cores(spark)),
              replay_first=replay_first)
    return spark.read.parquet(out).select(*COUNT_COLS)


def stream_append_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _closed_windows(spark, sf_dir, replay_first=False)


def stream_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The oldest slice is delivered again after the newest one; the watermark drops
    the re-delivered rows, so the closed windows still count every event once."""
    return _closed_windows(spark, sf_dir, replay_first=True)


def stream_chained_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-minute counts rolled up to two hours within one query: closed 2-hour windows and the
    5-minute windows inside them."""
    out, ckpt = scratch_path(spark, "chained_windows"), scratch_path(spark, "ckpt")
    _replayed(spark, sf_dir, lambda s: chained_window_stream(s, out, ckpt, trigger={"availableNow": True}, time_col="ts", state_partitions=_cores(spark)))
    rows = spark.read.parquet(out)
    parts = rows.select("user_id", F.inline("parts")).withColumnRenamed("n", "total_actions")
    return rows.select(F.lit("2 hours").alias("size"), *COUNT_COLS).union(parts.select(F.lit("5 minutes"), *COUNT_COLS))


def stream_state_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that end after the newest event, less the watermark delay: what the stream's state holds
    of them beside what its table says."""
    table_path, ckpt = scratch_path(spark, "user_aggregations"), scratch_path(spark, "ckpt")
    _replayed(spark, sf_dir, lambda s: aggregate_stream(s, table_path, ckpt, "2 hours", True, trigger={"availableNow": True},
                                                        state_partitions=_cores(spark), **EV))
    newest = plain_events(spark, sf_dir).agg((F.max("ts") - F.expr("INTERVAL 10 MINUTES")).cast("string")).first()[0]
    still = F.col("window_end") > F.lit(newest).cast("timestamp_ntz")
    key = ["user_id", "window_start", "window_end", "aggregation_type"]
    state = open_windows(spark, ckpt).filter(still).withColumnRenamed("total_actions", "in_state")
    rows = read_current(spark, table_path).filter(still).select(*key, F.col("total_actions").alias("in_table"))
    return state.join(rows, key, "full").select(*key, "in_state", "in_table")


def _json_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream of JSON text files: of fifty records one without a type, before each hundredth a broken one."""
    pin_utc(spark)
    text = scratch_path(spark, "json_text")
    bad = F.when(F.col("event_id") % 100 == 0, F.array(F.lit("garbage"), F.col("value"))).otherwise(F.array("value"))
    typeless = F.when(F.col("event_id") % 50 != 0, F.col("event_type"))
    fields = encode_json(plain_events(spark, sf_dir).withColumn("event_type", typeless), envelope_fields(), key="event_id")
    fields.select(F.explode(bad).alias("value")).write.text(text)
    return decode_events(spark.readStream.schema("value string").text(text))


def _fan_out_rows(spark: SparkSession, lake: DataFrame, rejects: DataFrame, root: str) -> DataFrame:
    """Every sink's rows in one list."""
    none = lambda kind: F.lit(None).cast(kind)
    landed = lake.groupBy("event_date", "event_hour").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("lake").alias("sink"), none("bigint").alias("user_id"),
        (F.col("event_date").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("event_hour"))).alias("window_start"),
        none("string").alias("aggregation_type"), F.col("n").alias("total_actions"))
    gone = rejects.agg(F.count(F.lit(1)).alias("n")).select(F.lit("rejects"), none("bigint"), none("timestamp_ntz"), none("string"), "n")
    tables = [read_current(spark, f"{root}/{t}").select(F.lit(t), "user_id", "window_start", "aggregation_type", "total_actions")
              for t in ("user_aggregations", "user_aggregations_realtime")]
    return landed.union(gone).union(tables[0]).union(tables[1])


def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text files to the lake, the rejects and both tables."""
    root = scratch_path(spark, "fan_out")
    events, rejects = split_corrupt(_json_text(spark, sf_dir))
    for q in start_all(events, root, {"availableNow": True}, rejects=rejects, state_partitions=_cores(spark)).values():
        q.awaitTermination()
    return _fan_out_rows(spark, spark.read.parquet(f"{root}/lake"), spark.read.parquet(f"{root}/rejects"), root)


def stream_fan_out_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from one landing query, each record parsed once; then its last batch again, as after a
    crash ahead of its commit: nothing lands twice."""
    root, decoded = scratch_path(spark, "fan_out"), _json_text(spark, sf_dir)

    def run() -> None:
        for q in start_fan_out(decoded, root, {"availableNow": True}, state_partitions=_cores(spark)).values():
            q.awaitTermination()

    run()
    undo_last_commit(spark, f"{root}/_checkpoints/landing")
    run()
    return _fan_out_rows(spark, read_landed(spark, f"{root}/lake"), read_landed(spark, f"{root}/lake", "rejects"), root)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "user_actions_2h": user_actions_2h,
    "user_action_types_2h": user_action_types_2h,
    "user_actions_5m": user_actions_5m,
    "user_aggregations_2h": user_aggregations_2h,
    "decode_events": decode_events_q,
    "device_info_flatten": device_info_flatten,
    **{f"metadata_{name}": _family(name)
       for name in ["product", "button", "search", "checkout", "location", "screen"]},
    "metadata_variant": metadata_variant,
    "metadata_keys": metadata_keys,
    "encode_events": encode_events,
    "partition_columns": partition_columns,
    "lake_roundtrip": lake_roundtrip,
    "lake_layout": lake_layout,
    "lake_bucket_layout": lake_bucket_layout,
    "lake_packed": lake_packed,
    "lake_point_lookup": lake_point_lookup,
    "lake_event_lookup": lake_event_lookup,
    "lake_backfill_2h": lake_backfill_2h,
    "agg_latest_wins": agg_latest_wins,
    "agg_compacted": agg_compacted,
    "agg_key_lookup": agg_key_lookup,
    "agg_current_lookup": agg_current_lookup,
    "agg_backfill_then_stream": agg_backfill_then_stream,
    "agg_replay_after_backfill": agg_replay_after_backfill,
    "late_slot_repair": late_slot_repair,
    "agg_month_partitions": agg_month_partitions,
    "realtime_ttl_7d": realtime_ttl_7d,
    "stream_user_aggregations_2h": stream_user_aggregations_2h,
    "stream_user_actions_5m": stream_user_actions_5m,
    "stream_append_closed_windows": stream_append_closed_windows,
    "stream_late_data": stream_late_data,
    "stream_seeded_restart": stream_seeded_restart,
    "stream_chained_windows": stream_chained_windows,
    "stream_state_audit": stream_state_audit,
    "stream_fan_out": stream_fan_out,
    "stream_fan_out_once": stream_fan_out_once,
}
