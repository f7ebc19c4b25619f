"""Replaying a table as a stream, slice by slice.

The table is cut into slices of equal event-time width.  ``stage_slices`` works out each
row's slice once and writes the table once, a directory per slice.  ``replay_slices`` then
moves one slice after the other into the source directory and runs the query on it, from
its checkpoint: a micro-batch holds exactly one slice, however many files it has.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def stage_slices(df: DataFrame, staged: str, time_col: str, n_slices: int = 6, replay_first: bool = False) -> int:
    """Write ``df`` as ``<staged>/slice=<i>``; with ``replay_first`` the oldest slice again at
    the end, as a late re-delivery.  Returns the number of slices.  Only the two time
    bounds reach the driver (``time_col`` is TIMESTAMP_NTZ)."""
    micros = F.unix_micros(F.col(time_col).cast("timestamp"))
    lo, hi = df.agg(F.min(micros), F.max(micros)).first()
    if lo is None:
        return 0
    width = (hi - lo) // n_slices + 1
    own = F.floor((micros - F.lit(lo)) / F.lit(width)).cast("int")
    if replay_first:
        own = F.explode(F.when(own == 0, F.array(own, F.lit(n_slices))).otherwise(F.array(own)))
    df.select("*", own.alias("slice")).write.partitionBy("slice").parquet(staged)
    return n_slices + int(replay_first)


def file_stream(spark: SparkSession, path: str, schema: StructType, max_files_per_trigger: int | None = None
                ) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def replay_slices(df: DataFrame, source_path: str, time_col: str, start: Callable[[], StreamingQuery],
                  n_slices: int = 6, replay_first: bool = False, timeout_s: int | None = None):
    """Feed ``df`` to a file-source stream slice by slice; ``start()`` must start the query
    on ``source_path`` with an ``availableNow`` trigger and a fixed checkpoint.

    Returns the summed progress of all runs.
    """
    from actiontally.streaming.jobs import StreamResult, run_to_completion

    spark = df.sparkSession
    staged = f"{source_path}-staged-{uuid.uuid4().hex[:8]}"
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(source_path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(source_path))
    total = StreamResult()
    for i in range(stage_slices(df, staged, time_col, n_slices, replay_first)):
        files = fs.globStatus(path(f"{staged}/slice={i}/*.parquet")) or []
        for f in files:
            fs.rename(f.getPath(), path(f"{source_path}/{i:04d}-{f.getPath().getName()}"))
        if not files:
            continue
        res = run_to_completion(start, timeout_s)
        total.batches += res.batches
        total.input_rows += res.input_rows
        total.dropped_late += res.dropped_late
        total.progress.extend(res.progress)
    return total


def undo_last_commit(spark: SparkSession, checkpoint: str) -> int:
    """Take back the checkpoint's last commit record, as if the query had ended after its sink's write and
    ahead of it: the next start runs that batch again.  Returns the batch id."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(checkpoint).getFileSystem(spark._jsc.hadoopConfiguration())
    last = max(int(f.getPath().getName()) for f in fs.listStatus(path(f"{checkpoint}/commits")) if f.getPath().getName().isdigit())
    fs.delete(path(f"{checkpoint}/commits/{last}"), False)
    return last
