"""Packing of a landing lake's many small files into few of a wanted size.

A stream leaves a file per source partition and micro-batch in every slot. Here each closed slot is
rewritten as ``ceil(bytes / target)`` files, sorted, with a range of users in each; the bytes are those of
its landed files. Tasks are filled like bins: a large slot takes one task for each of its files, small
neighbouring slots share one up to a smaller size, as a task sorts its rows unpacked, in several times
the bytes they have in files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actiontally.functions.layout import N_BUCKETS, PARTITION_COLUMNS
from actiontally.functions.ranges import POINTS, range_id, sketch_columns, split_points
from actiontally.sources.changelog import read_tag
from actiontally.sources.lake import check_layout, check_slots, lake_scan

TARGET_BYTES = 256 << 20
#: Landed bytes that slots sharing a task may have together.
SHARED_BYTES = 16 << 20


def slot_files(lake: DataFrame) -> DataFrame:
    """``event_date, event_hour, files, bytes`` of the slots of a lake's rows, from the files' metadata: no
    column but the partitions' is read, and a task sends a row per file."""
    each = lake.select(*PARTITION_COLUMNS, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    files = each.groupBy(*PARTITION_COLUMNS, "file").agg(F.first("size").alias("size"))
    return files.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))


def fill_tasks(slots: list[tuple], target: int, shared: int | None = None) -> list[tuple]:
    """``(date, hour, pieces, first task)`` of ``(date, hour, bytes)``: a slot above the target has a task for
    each piece, smaller ones go into the open task while they fit in ``shared`` bytes (the target, if
    None); one above that has a task by itself."""
    out, task, room = [], -1, 0
    shared = target if shared is None else min(target, shared)
    for day, hour, size in sorted(slots):
        pieces = max(1, -(-size // target))
        if pieces > 1:
            out.append((day, hour, pieces, task + 1))
            task, room = task + pieces, 0
        else:
            if size > room or task < 0:
                task, room = task + 1, shared
            out.append((day, hour, 1, task))
            room -= size
    return out


def piece_of(user: Column, time: Column, splits: list[int], pieces: Column) -> Column:
    """Which of ``pieces`` equal parts a row lies in, in the order of its user. A row's place is its user's
    range and, within it, a hash: ranges of any number make pieces of any number, and a user that fills
    several ranges several pieces."""
    unit = F.pmod(F.xxhash64(user, time), F.lit(1 << 20)) / float(1 << 20)
    place = (range_id(user, splits, time) + unit) / float(len(splits) + 1)
    return F.least(F.floor(place * pieces).cast("int"), pieces - 1)


def pack_slots(spark: SparkSession, landing_path: str, lake_path: str, start, end, target_bytes: int = TARGET_BYTES,
               time_col: str = "event_time", user_col: str = "user_id") -> int:
    """Rewrite the closed slots ``[start, end)`` of a landing lake as few files; returns the number of tasks.

    Three passes: the files' metadata, the user column (for the split points) and the rows, which are
    shuffled once. The driver holds a row per slot, twelve a day. Slots are replaced whole (dynamic
    partition overwrite), so a rerun gives the same; rows stay as they are, repeats included. A range
    without rows changes nothing. Null users are in the first range."""
    check_slots(start, end)
    if target_bytes < 1:
        raise ValueError("the wanted size of a file must be positive")
    rows = lake_scan(spark, landing_path, start=start, end=end, time_col=time_col)
    slots = [(r.event_date, r.event_hour, r.bytes) for r in slot_files(rows).collect()]
    if not slots:
        return 0
    check_layout(spark, lake_path, False, int(read_tag(spark, landing_path, "n_buckets") or N_BUCKETS))
    dealt = fill_tasks(slots, target_bytes, SHARED_BYTES)
    tasks = 1 + max(first + pieces - 1 for _, _, pieces, first in dealt)
    splits: list[int] = []
    if any(pieces > 1 for _, _, pieces, _ in dealt):
        sketch = rows.agg(*sketch_columns(user_col)).first().asDict()
        splits = split_points([sketch], -(-sketch["n"] // POINTS))
    pieces, first, task = "_pieces", "_first", "_task"
    plan = spark.createDataFrame(dealt, f"event_date date, event_hour int, {pieces} int, {first} int")
    named = rows.join(F.broadcast(plan), PARTITION_COLUMNS)  # a row per slot of the range
    placed = named.withColumn(task, F.col(first) + piece_of(F.col(user_col), F.col(time_col), splits, F.col(pieces)))
    (placed.repartitionById(tasks, F.col(task))
        .sortWithinPartitions(*PARTITION_COLUMNS, user_col, time_col).drop(pieces, first, task)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITION_COLUMNS).parquet(lake_path))
    return tasks
