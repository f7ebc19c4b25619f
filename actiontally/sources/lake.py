"""The event lake: Parquet laid out by date, two-hour slot and user bucket.

Write: one shuffle by (date, slot, bucket, salt), then a sort within partitions.  The salt
spreads a hot user's bucket over several tasks; files carry tight min/max statistics.

``bucket`` is a third directory level (``bucket_dirs=True``) or a sorted column, pruned
by Parquet statistics rather than by directory.  The layout and the number of buckets
are properties of the lake: the first write records them, later writes with others are
refused, and reads go by what is recorded.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actiontally.functions.literals import as_datetime, day, ntz
from actiontally.functions.layout import (
    N_BUCKETS, PARTITION_COLUMNS, SLOT_HOURS, with_partition_columns,
)
from actiontally.schemas import CORRUPT_COL
from actiontally.sources.changelog import read_tag, write_tag

#: Tasks that may share one leaf's rows.
SALTS = 4
#: First directory level of a lake that one query fills with events and rejected records.
LANDED, REJECTED = "lake", "rejects"


def write_lake(df: DataFrame, path: str, time_col: str = "event_time", user_col: str = "user_id",
               n_buckets: int = N_BUCKETS, bucket_dirs: bool = False, mode: str = "append",
               max_records_per_file: int = 2_000_000, salts: int = SALTS, bloom: tuple[str, ...] = ()) -> None:
    """Land events in the lake, reading ``df`` once.  ``mode="overwrite"`` replaces only the
    slots present in ``df`` (dynamic partition overwrite), which makes a backfill of one
    day rerunnable.  Size ``salts`` to the largest leaf: its rows over one task's share.

    Columns in ``bloom`` get a Bloom filter per row group, sized by the values it has: equality on
    them then skips row groups whose minimum and maximum say nothing, as of random ids."""
    check_layout(df.sparkSession, path, bucket_dirs, n_buckets)
    out = with_partition_columns(df, time_col, user_col, n_buckets)
    salt = F.pmod(F.xxhash64(F.col(time_col), F.col(user_col)), F.lit(salts))
    parts = PARTITION_COLUMNS + (["bucket"] if bucket_dirs else [])
    (out.repartition(F.col("event_date"), F.col("event_hour"), F.col("bucket"), salt)
        .sortWithinPartitions("event_date", "event_hour", "bucket", user_col, time_col)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .options(**_bloom_options(bloom))
        .partitionBy(*parts)
        .parquet(path))


def _bloom_options(columns: tuple[str, ...]) -> dict[str, str]:
    out = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    return out | ({"parquet.bloom.filter.adaptive.enabled": "true"} if out else {})


def mark_fan_out(spark: SparkSession, path: str) -> None:
    """Record that this lake has rejected records beside its events."""
    if read_tag(spark, path, "fan_out") is None:
        write_tag(spark, path, "fan_out", "1")


def read_landed(spark: SparkSession, path: str, sink: str = LANDED) -> DataFrame:
    """The events (``lake``) or the rejected records (``rejects``) of a lake that one query fills with both."""
    rows = spark.read.parquet(path).filter(F.col("sink") == sink).drop("sink")
    return rows.drop(CORRUPT_COL) if sink == LANDED else rows.drop(*PARTITION_COLUMNS, "bucket")


def check_layout(spark: SparkSession, path: str, bucket_dirs: bool, n_buckets: int = N_BUCKETS) -> None:
    """Record a new lake's layout, or refuse a write whose layout differs from it."""
    for name, asked in (("bucket_dirs", int(bool(bucket_dirs))), ("n_buckets", n_buckets)):
        recorded = read_tag(spark, path, name)
        if recorded is None:
            write_tag(spark, path, name, str(asked))
        elif int(recorded) != asked:
            raise ValueError(f"lake {path} was written with {name}={recorded}; this write asks for {asked}")


def is_landing(spark: SparkSession, path: str) -> bool:
    """Whether the streaming file sink writes this lake: only its commit log tells which files count."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_spark_metadata")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def check_slots(start, end) -> None:
    """Refuse a range that cuts a slot: recomputing part of a slot would replace the whole of it."""
    for t in (as_datetime(start), as_datetime(end)):
        if t.hour % SLOT_HOURS or t.minute or t.second or t.microsecond:
            raise ValueError(f"{t} is not on a {SLOT_HOURS}-hour slot bound")


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    return read_landed(spark, path) if read_tag(spark, path, "fan_out") else spark.read.parquet(path)


def lake_scan(spark: SparkSession, path: str, user_id: int | None = None, start=None, end=None,
              time_col: str = "event_time", user_col: str = "user_id") -> DataFrame:
    """Events of one user and/or a ``[start, end)`` time range, reading only what can match.

    Spark does not derive partition predicates from predicates on the event time or the
    user, so this adds them: ``event_date`` always, ``event_hour`` when the range lies in
    one day, ``bucket`` for a user (by the lake's own number of buckets).  With both bounds
    the listing itself is limited to the matching date directories, except in a landing
    lake, which is read through its commit log.
    """
    cond, src = F.lit(True), path
    s, e = (None if t is None else as_datetime(t) for t in (start, end))
    if s is not None:
        cond = cond & (F.col("event_date") >= day(s.date())) & (F.col(time_col) >= ntz(s))
    if e is not None:
        last = e - dt.timedelta(microseconds=1)
        cond = cond & (F.col("event_date") <= day(last.date())) & (F.col(time_col) < ntz(e))
    if s is not None and e is not None:
        days = [(s.date() + dt.timedelta(days=i)) for i in range((last.date() - s.date()).days + 1)]
        if s >= e:
            return read_lake(spark, path).filter(F.lit(False))
        if not is_landing(spark, path):
            src = f"{path}/event_date={{{','.join(d.isoformat() for d in days)}}}"
        if len(days) == 1:
            lo, hi = s.hour // SLOT_HOURS * SLOT_HOURS, last.hour // SLOT_HOURS * SLOT_HOURS
            cond = cond & F.col("event_hour").between(lo, hi)
    if user_id is not None:
        n_buckets = int(read_tag(spark, path, "n_buckets") or N_BUCKETS)
        cond = cond & (F.col("bucket") == F.lit(user_id % n_buckets)) & (F.col(user_col) == F.lit(user_id))
    try:
        df = spark.read.option("basePath", path).parquet(src) if src != path else read_lake(spark, path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        # No directory for any day in range: an empty result with the lake's columns.
        return read_lake(spark, path).filter(F.lit(False))
    return df.filter(cond)
