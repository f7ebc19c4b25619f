"""Streaming queries for the three sinks of the action stream.

* ``aggregate_stream``: windowed counts in ``update`` mode; each micro-batch lands in
  the change log as the checkpoint's own ``version=<batch id>`` (idempotent on replay)
  and readers take the row of each key written last, which repairs the repeated
  emission of open windows.
* ``closed_window_stream``: ``append`` mode, a window is written once, after the
  watermark passes its end.
* ``lake_stream``: every event into the lake through the exactly-once file sink.

Event time must be TIMESTAMP for a watermark; decoded events carry TIMESTAMP_NTZ, so
the column is cast and window edges are cast back.  Both casts use the session zone,
which is pinned to UTC before the plan is built; under another zone every window
would shift.
Each query owns its checkpoint; the state partition count is fixed for the life of a
checkpoint, so size it before the first start.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from actiontally.functions.decode import countable
from actiontally.functions.layout import with_partition_columns
from actiontally.functions.literals import as_datetime, ntz
from actiontally.functions.windows import window_bounds
from actiontally.session import pin_utc
from actiontally.operators.aggregates import type_tag, user_action_counts, user_aggregations
from actiontally.schemas import ACTION_TAG_PREFIX, CORRUPT_COL, NO_TYPE, TOTAL_TAG
from actiontally.sources.changelog import has_history, read_tag, write_changes, write_tag
from actiontally.sources.lake import LANDED, REJECTED, SALTS, check_layout, check_slots, lake_scan, mark_fan_out, write_lake

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _with_event_time(events: DataFrame, time_col: str, watermark: str, dedup: bool = False) -> DataFrame:
    # The cast's zone is fixed when the plan is built: pin UTC first (see module doc).
    pin_utc(events.sparkSession)
    ev = events.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, watermark)
    return ev.dropDuplicatesWithinWatermark(["event_id"]) if dedup else ev


def _writer(df: DataFrame, checkpoint: str, trigger: dict | None, name: str | None):
    w = df.writeStream.option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    return w.trigger(**(trigger or {"processingTime": "5 minutes"}))


def stream_writer(spark, table_path: str, checkpoint: str, since=None, duration: str = "2 hours",
                  seed: DataFrame | None = None, watermark: str = "10 minutes", with_types: bool = True) -> tuple[str, str | None]:
    """Writer id of the query behind ``checkpoint`` and the bound it counts from, both
    recorded beside the checkpoint when it is first used.

    A new checkpoint knows nothing of the windows that a former one left open: its counts of
    them would replace the former's.  On a table that ever had rows it must therefore either
    be given the table's current rows (``seed``): the open windows' counts are then written
    beside the checkpoint and enter its state with the first micro-batch.  Or it must say from which
    window on (``since``) it counts; earlier windows are left as they are, to be
    backfilled from the lake if need be.
    """
    writer = read_tag(spark, checkpoint, "writer")
    if writer is None:
        if since is None and seed is not None:
            since = write_seed(seed, checkpoint, duration, watermark, with_types)
        elif since is None and has_history(spark, table_path):
            raise ValueError(f"{table_path} has rows of other writers: a new checkpoint needs ``seed``, the table's current rows, "
                             "or ``since``, the start of its first window")
        if since is not None:
            start = spark.range(1).select(F.window(ntz(since), duration).start.cast("string"), ntz(since).cast("string")).first()
            if start[0] != start[1]:
                raise ValueError(f"{since} does not start a window of {duration}")
            write_tag(spark, checkpoint, "since", as_datetime(since).strftime("%Y%m%dT%H%M%S"))
        writer = f"stream_{uuid.uuid4().hex[:12]}"
        write_tag(spark, checkpoint, "writer", writer)
    kept = read_tag(spark, checkpoint, "since")
    return writer, kept and f"{kept[:4]}-{kept[4:6]}-{kept[6:8]} {kept[9:11]}:{kept[11:13]}:{kept[13:15]}"


SEED_SCHEMA = "user_id bigint, seed_time timestamp_ntz, action_type string, weight bigint"


def write_seed(current: DataFrame, checkpoint: str, duration: str, watermark: str, with_types: bool):
    """Counts of the windows that may still be open, as weighted rows beside the checkpoint; returns
    the start of the first such window (None for an empty table).

    The newest event lies in the newest window or is older than its end, so every window that ends
    after the newest one's start less the watermark delay may be open; a few closed ones among them
    do no harm.  The stream that left them must have stopped, and the new one must read on
    where that one stopped."""
    spark = current.sparkSession
    newest = F.max("window_start").cast("timestamp") - F.expr(f"INTERVAL {watermark}")
    bound = F.window(F.col("bound"), duration).start.cast("timestamp_ntz").cast("string")
    first = current.agg(newest.alias("bound")).filter("bound is not null").select(bound).first()
    if first is None:
        return None
    tag = F.col("aggregation_type")
    rows = current.filter(F.col("window_start") >= ntz(first[0]))
    rows = rows.filter(tag.startswith(ACTION_TAG_PREFIX)) if with_types else rows.filter(tag == TOTAL_TAG)
    kind = F.when(tag != F.lit(ACTION_TAG_PREFIX + NO_TYPE), F.substring(tag, len(ACTION_TAG_PREFIX) + 1, 1 << 30)) if with_types else F.lit(None)
    rows.select("user_id", F.col("window_start").alias("seed_time"), kind.cast("string").alias("action_type"), F.col("total_actions").alias("weight")) \
        .write.mode("overwrite").parquet(f"{checkpoint}/seed")
    write_tag(spark, checkpoint, "seeded", "1")
    return first[0]


def with_seed(events: DataFrame, checkpoint: str, time_col: str, user_col: str, type_col: str, with_types: bool, dedup: bool) -> DataFrame:
    """The events, a ``weight`` of 1 each, and the checkpoint's seed rows, which make its first
    micro-batch's counts start from the table's.  One watermark goes over both."""
    spark = events.sparkSession
    seed = spark.readStream.schema(SEED_SCHEMA).parquet(f"{checkpoint}/seed")
    cols = [(user_col, F.col("user_id")), (time_col, F.col("seed_time"))] + ([(type_col, F.col("action_type"))] if with_types else [])
    kinds = dict(events.dtypes)
    rows = events.select(*(c for c, _ in cols), F.lit(1).cast("bigint").alias("weight"), *(["event_id"] if dedup else []))
    # Each seed row has an id of its own, so that none passes for a repeat of another.
    own = F.concat_ws(" ", F.lit("seed"), "user_id", "seed_time", F.coalesce("action_type", F.lit(NO_TYPE)))
    if dedup and kinds["event_id"] != "string":
        rows = rows.withColumn("event_id", F.col("event_id").cast("string"))
    return rows.unionByName(seed.select(*(v.cast(kinds[c]).alias(c) for c, v in cols), "weight", *([own.alias("event_id")] if dedup else [])))


@contextmanager
def _start_settings(spark, state_store: str | None, state_partitions: int | None, evict_without_data: bool = True):
    """Session settings a stateful query captures when it starts.

    At full scale the per-type counts keep ~125M open keys (30M users, ~4 types per
    user and window), so state belongs off-heap in RocksDB, checkpointed as change
    logs.  The state partition count is fixed for the life of a checkpoint; size it
    for the peak.  Spark copies the session settings when a query starts and keeps them
    in the checkpoint, so they are set only around ``start()`` and restored after.

    ``evict_without_data=False`` skips the extra micro-batch Spark runs only to move the
    watermark: an update-mode query emits nothing on eviction, so its state is simply
    evicted at the next batch with data.
    """
    wanted = {}
    if state_store == "rocksdb":
        wanted["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB
        wanted["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
    if state_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(int(state_partitions))
    if not evict_without_data:
        wanted["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    old = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def aggregate_stream(events: DataFrame, table_path: str, checkpoint: str, duration: str = "2 hours",
                     with_types: bool = True, watermark: str = "10 minutes", trigger: dict | None = None,
                     time_col: str = "event_time", user_col: str = "user_id", type_col: str = "action_type",
                     export=None, name: str | None = None, state_store: str | None = "rocksdb",
                     dedup: bool = False, state_partitions: int | None = None,
                     output_files: int | None = None, since=None, seed: DataFrame | None = None) -> StreamingQuery:
    """Totals (and per-type counts) per user and window into a versioned change log.

    A new checkpoint on a table that has had rows needs ``seed`` (the table's current rows: it goes on
    counting their open windows) or ``since`` (the window from which it counts).
    With ``dedup`` a repeated ``event_id`` within the watermark delay counts once.
    Each micro-batch writes one file per state partition; with thousands of state
    partitions set ``output_files`` to shuffle just the batch's updated rows into that
    many files (compaction merges versions later either way).
    """
    pin_utc(events.sparkSession)
    spark = events.sparkSession
    writer, first = stream_writer(spark, table_path, checkpoint, since, duration, seed, watermark, with_types)
    if first:
        events = events.filter(F.col(time_col) >= ntz(first))
    weight = "weight" if read_tag(spark, checkpoint, "seeded") else None
    if weight:
        events = with_seed(events, checkpoint, time_col, user_col, type_col, with_types, dedup)
    ev = _with_event_time(events, time_col, watermark, dedup)
    if with_types:
        agg = user_aggregations(ev, duration, time_col, user_col, type_col, weight)
    else:
        agg = user_action_counts(ev, duration, False, time_col, user_col, type_col, weight) \
            .withColumn("aggregation_type", F.lit(TOTAL_TAG))

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = batch.repartition(output_files) if output_files else batch
        write_changes(rows, table_path, batch_id, export, writer)

    with _start_settings(events.sparkSession, state_store, state_partitions, evict_without_data=False):
        return _writer(agg, checkpoint, trigger, name).outputMode("update").foreachBatch(sink).start()


def open_windows(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """What an ``aggregate_stream`` holds in its state as of its last commit, as rows of its table: an audit of a
    stopped query, or of a running one between batches.  Windows that the watermark has passed stay
    here until a later batch evicts them.  With ``dedup`` the query has two stateful operators; ``operator`` is
    the counting one's number."""
    pin_utc(spark)
    state = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    key, count = state.schema["key"].dataType.names, state.schema["value"].dataType.names[0]
    tag = F.lit(TOTAL_TAG)
    if "action_type" in key:  # grouping sets: the id's bit is set where the type is left out
        tag = F.when(F.col("key.spark_grouping_id") != 0, tag).otherwise(type_tag("key.action_type"))
    return state.select("key.user_id", *window_bounds("key.window"), F.col(f"value.{count}").alias("total_actions"), tag.alias("aggregation_type"))


def closed_window_stream(events: DataFrame, out_path: str, checkpoint: str, duration: str = "2 hours",
                         watermark: str = "10 minutes", trigger: dict | None = None,
                         time_col: str = "event_time", user_col: str = "user_id",
                         name: str | None = None, state_store: str | None = "rocksdb",
                         state_partitions: int | None = None, with_types: bool = False,
                         type_col: str = "action_type", output_files: int | None = None) -> StreamingQuery:
    """Final counts of closed windows only, each written exactly once (file sink); with
    ``with_types`` the long table of totals and per-type counts.  ``output_files``
    shuffles each micro-batch's closed windows into that many files."""
    ev = _with_event_time(events, time_col, watermark)
    if with_types:
        agg = user_aggregations(ev, duration, time_col, user_col, type_col)
    else:
        agg = user_action_counts(ev, duration, False, time_col, user_col)
    if output_files:
        agg = agg.repartition(output_files)
    with _start_settings(events.sparkSession, state_store, state_partitions):
        return _writer(agg, checkpoint, trigger, name).outputMode("append").format("parquet") \
            .option("path", out_path).start()


def chained_window_stream(events: DataFrame, out_path: str, checkpoint: str, watermark: str = "10 minutes", trigger: dict | None = None,
                          time_col: str = "event_time", user_col: str = "user_id", short: str = "5 minutes", long: str = "2 hours",
                          name: str | None = None, state_store: str | None = "rocksdb", state_partitions: int | None = None) -> StreamingQuery:
    """Both window lengths in one query: short windows' counts are rolled up to the long ones by
    ``window_time``, two stateful operators after another, append mode.

    The events meet state once, by user and short window; the second operator gets closed short
    windows only.  A row per user and closed long window, written once: ``user_id, window_start, window_end,
    total_actions`` and ``parts``, its short windows with their counts (as many as a long window holds)."""
    ev = _with_event_time(events, time_col, watermark)
    part = ev.groupBy(F.col(user_col).alias("user_id"), F.window(time_col, short).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    part = part.select("user_id", F.window_time("w").alias("at"), F.struct(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end"), "n").alias("part"))
    agg = part.groupBy("user_id", F.window("at", long).alias("window")).agg(F.sum("part.n").alias("total_actions"), F.collect_list("part").alias("parts"))
    out = agg.select("user_id", *window_bounds("window"), "total_actions", "parts")
    with _start_settings(events.sparkSession, state_store, state_partitions):
        return _writer(out, checkpoint, trigger, name).outputMode("append").format("parquet").option("path", out_path).start()


def lake_stream(events: DataFrame, lake_path: str, checkpoint: str, trigger: dict | None = None,
                time_col: str = "event_time", user_col: str = "user_id", bucket_dirs: bool = False,
                salts: int = SALTS, name: str | None = None) -> StreamingQuery:
    """Every event into the landing lake through the exactly-once file sink.

    Without bucket directories there is no shuffle: each source partition (balanced by
    the topic, which has no message key) writes its rows into the slot directories it
    touches.  With bucket directories rows are clustered by leaf plus a small salt, so
    a hot user's bucket spreads over ``salts`` tasks (size it to the largest leaf of a
    micro-batch) while a leaf still gets at most ``salts`` files per micro-batch.
    Streams cannot sort: ``curate_slots`` rewrites closed slots sorted into the batch
    lake, and drops repeats there.  Late and repeated events all land.
    """
    check_layout(events.sparkSession, lake_path, bucket_dirs)
    out = with_partition_columns(events, time_col, user_col)
    if bucket_dirs:
        salt = F.pmod(F.xxhash64(F.col("event_id")), F.lit(salts))
        out = out.repartition(F.col("event_date"), F.col("event_hour"), F.col("bucket"), salt)
    parts = ["event_date", "event_hour"] + (["bucket"] if bucket_dirs else [])
    return _writer(out, checkpoint, trigger, name).outputMode("append").format("parquet") \
        .option("path", lake_path).partitionBy(*parts).start()


def landing_stream(decoded: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, time_col: str = "event_time",
                   user_col: str = "user_id", bucket_dirs: bool = False, name: str | None = None) -> StreamingQuery:
    """Countable events and rejected records in one query: each record is parsed once.

    ``decoded`` is the output of ``decode_events``.  The file sink's one commit covers both sides, so
    a restart between them can neither lose nor repeat a record.  They are told apart by a first
    directory level, ``sink=lake`` or ``sink=rejects``; ``read_landed`` reads either, and
    ``lake_scan`` the events.  Rejects lie in one directory, under no date.  No shuffle: every source
    partition writes the directories it touches.
    """
    check_layout(decoded.sparkSession, path, bucket_dirs)
    mark_fan_out(decoded.sparkSession, path)
    parts = ["event_date", "event_hour"] + (["bucket"] if bucket_dirs else [])
    kinds = {f.name: f.dataType for f in with_partition_columns(decoded, time_col, user_col).schema}
    out = with_partition_columns(decoded.withColumn("sink", F.when(countable(time_col, user_col), LANDED).otherwise(REJECTED)), time_col, user_col)
    out = out.select("*", *[F.when(F.col("sink") == LANDED, F.col(p)).cast(kinds[p]).alias(f"_{p}") for p in parts]) \
        .drop(*parts).withColumnsRenamed({f"_{p}": p for p in parts})
    return _writer(out, checkpoint, trigger, name).outputMode("append").format("parquet") \
        .option("path", path).partitionBy("sink", *parts).start()


def landed_feed(decoded: DataFrame, path: str, time_col: str = "event_time", user_col: str = "user_id") -> DataFrame:
    """The events that ``landing_stream`` has committed, as a stream."""
    schema = with_partition_columns(decoded, time_col, user_col).withColumn("sink", F.lit(LANDED)).schema
    return decoded.sparkSession.readStream.schema(schema).parquet(path).filter(F.col("sink") == LANDED).drop("sink", CORRUPT_COL)


def curate_slots(spark, landing_path: str, lake_path: str, start, end, time_col: str = "event_time",
                 user_col: str = "user_id", bucket_dirs: bool = False, dedup: bool = False) -> None:
    """Rewrite the closed slots ``[start, end)`` of the landing lake into the sorted batch
    lake (dynamic partition overwrite, so a rerun replaces the same slots).  The bounds
    must be slot bounds; with ``dedup`` one event of each ``event_id`` stays."""
    check_slots(start, end)
    rows = lake_scan(spark, landing_path, start=start, end=end, time_col=time_col)
    if dedup:
        rows = rows.dropDuplicates(["event_id"])
    rows = rows.drop("event_date", "event_hour", "bucket")
    write_lake(rows, lake_path, time_col, user_col, bucket_dirs=bucket_dirs, mode="overwrite")


@dataclass
class StreamResult:
    batches: int = 0
    input_rows: int = 0
    dropped_late: int = 0
    progress: list = field(default_factory=list)


class Reports(StreamingQueryListener):
    """Keeps every progress report it hears of, by run and batch."""

    def __init__(self) -> None:
        self.seen: dict[tuple[str, int, str], object] = {}

    def add(self, p) -> None:
        self.seen[str(p.runId), p.batchId, p.timestamp] = p

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.add(event.progress)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def run_to_completion(query: StreamingQuery | Callable[[], StreamingQuery], timeout_s: int | None = None) -> StreamResult:
    """Wait for an ``availableNow`` query (or one that the callable starts), without limit
    unless one is given, and sum up its progress reports: those heard by a listener and the
    last ones that the query itself keeps."""
    spark, reports = SparkSession.getActiveSession(), Reports()
    spark.streams.addListener(reports)
    try:
        query = query() if callable(query) else query
        finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination() is None
        if not finished:
            query.stop()
            raise TimeoutError(f"stream {query.name or query.id} did not finish in {timeout_s}s")
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
    finally:
        spark.streams.removeListener(reports)
    for p in query.recentProgress:
        reports.add(p)
    res = StreamResult()
    for (run, _, _), p in sorted(reports.seen.items(), key=lambda x: x[0]):
        if run == str(query.runId):
            res.progress.append(p)
            res.batches += 1
            res.input_rows += int(p.numInputRows or 0)
            res.dropped_late += sum(int(op.numRowsDroppedByWatermark or 0) for op in p.stateOperators or [])
    return res


def start_landing(events: DataFrame, root: str, trigger: dict | None = None, rejects: DataFrame | None = None,
                  bucket_dirs: bool = False) -> dict[str, StreamingQuery]:
    """Every event into the lake, every rejected record into ``rejects`` (Parquet, as it is)."""
    out = {"lake": lake_stream(events, f"{root}/lake", f"{root}/_checkpoints/lake", trigger, bucket_dirs=bucket_dirs, name="lake")}
    if rejects is not None:
        out["rejects"] = _writer(rejects, f"{root}/_checkpoints/rejects", trigger, "rejects").outputMode("append") \
            .format("parquet").option("path", f"{root}/rejects").start()
    return out


def start_aggregates(events: DataFrame, root: str, trigger: dict | None = None, watermark: str = "10 minutes",
                     realtime_window: str = "5 minutes", export_2h=None, export_5m=None, dedup: bool = False,
                     state_partitions: int | None = None, output_files: int | None = None, since=None,
                     aggregates_from: str = "lake", feed: DataFrame | None = None) -> dict[str, StreamingQuery]:
    """Both aggregate tables, from the landing lake's committed files (its log makes that
    exactly-once, and no record is parsed again) or, with ``aggregates_from="source"``,
    from the source itself, or from the stream ``feed``."""
    if feed is None and aggregates_from == "source":
        feed = events
    elif feed is None:
        landed = with_partition_columns(events, "event_time", "user_id").schema
        feed = events.sparkSession.readStream.schema(landed).parquet(f"{root}/lake")
    agg = dict(trigger=trigger, watermark=watermark, dedup=dedup, state_partitions=state_partitions,
               output_files=output_files, since=since)
    return {
        "user_aggregations": aggregate_stream(
            feed, f"{root}/user_aggregations", f"{root}/_checkpoints/user_aggregations", "2 hours", True,
            export=export_2h, name="user_aggregations", **agg),
        "user_aggregations_realtime": aggregate_stream(
            feed, f"{root}/user_aggregations_realtime", f"{root}/_checkpoints/user_aggregations_realtime",
            realtime_window, False, export=export_5m, name="user_aggregations_realtime", **agg)}


def start_all(events: DataFrame, root: str, trigger: dict | None = None, watermark: str = "10 minutes",
              rejects: DataFrame | None = None, bucket_dirs: bool = False, **agg) -> dict[str, StreamingQuery]:
    """One decoded source fanned out to the lake, the rejects and both aggregate tables.

    State is per query, so each sink has its own checkpoint under ``root``.  With an
    ``availableNow`` trigger the lake is landed first, so that the tables see all of it.
    """
    queries = start_landing(events, root, trigger, rejects, bucket_dirs)
    if trigger and trigger.get("availableNow"):
        for q in queries.values():
            q.awaitTermination()
    queries.update(start_aggregates(events, root, trigger, watermark, **agg))
    return queries


def start_fan_out(decoded: DataFrame, root: str, trigger: dict | None = None, watermark: str = "10 minutes",
                  bucket_dirs: bool = False, **agg) -> dict[str, StreamingQuery]:
    """As ``start_all``, from records not yet split: one landing query for events and rejects, and both
    aggregate tables from what it has committed, so that each record is parsed once in all."""
    path = f"{root}/lake"
    queries = {"landing": landing_stream(decoded, path, f"{root}/_checkpoints/landing", trigger, bucket_dirs=bucket_dirs, name="landing")}
    if trigger and trigger.get("availableNow"):
        queries["landing"].awaitTermination()
    queries.update(start_aggregates(decoded, root, trigger, watermark, feed=landed_feed(decoded, path), **agg))
    return queries
