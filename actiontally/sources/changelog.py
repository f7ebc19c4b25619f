"""Aggregate tables as change logs: each write lands in ``writer=<id>/version=<n>``.

A writer is one stream checkpoint or one backfill run; nobody else writes its
directories, so writers can't replace each other's rows.  Rewriting a writer's version
replaces it, so a replayed stream batch (the same batch id) is idempotent.  A version
counts once its ``_SUCCESS`` file is there.

Before its first write a version claims the next number of the table's sequence (a name in
``_sequence``) and a write time, and keeps both when it is written again.  Readers collapse versions
with ``latest_versions``: of each key the row of the highest number wins, so a replay never
overtakes what was written after the version's first time.  The numbers also tell that a table has
had rows, after a compaction took them over.

Beside its rows a version keeps a sketch of their users (``_sketch``), taken while they are
written; compactions cut their user ranges by it.  A compaction lists the versions it covers
(``_covered``); readers add every other committed version to it, and ``remove_covered``
deletes the covered ones.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from actiontally.functions.layout import yyyymm
from actiontally.functions.literals import ntz
from actiontally.functions.ranges import range_id, sketch_columns

MAIN = "main"
#: Fixed value: the columns of the serving tables.
EXPORT_COLUMNS = ["user_id", "window_start", "window_end", "total_actions", "aggregation_type", "updated_at"]


@dataclass(frozen=True, order=True)
class Claim:
    """A version's place in the table's sequence and its first write time (microseconds)."""

    number: int
    stamp: int
    version: int
    writer: str


def claims(spark: SparkSession, table_path: str) -> list[Claim]:
    """The claims of a table, ascending (names from one listing)."""
    fs, path = _fs(spark, table_path)
    out = []
    for st in fs.globStatus(path(f"{table_path}/_sequence/*")) or []:
        number, stamp, version, writer = st.getPath().getName().split("-", 3)
        out.append(Claim(int(number), int(stamp), int(version), writer))
    return sorted(out)


def claim(spark: SparkSession, table_path: str, writer: str, version: int) -> Claim:
    """The version's claim: the one it has, or a number above all that are taken.  Writers that claim
    at the same moment may get the same number; they are told apart by a hash (``write_order``)."""
    taken = claims(spark, table_path)
    for c in taken:
        if (c.writer, c.version) == (writer, version):
            return c
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - dt.datetime(1970, 1, 1)
    new = Claim(taken[-1].number + 1 if taken else 1, now // dt.timedelta(microseconds=1), version, writer)
    fs, path = _fs(spark, table_path)
    fs.create(path(f"{table_path}/_sequence/{new.number:012d}-{new.stamp}-{new.version}-{new.writer}"), True).close()
    return new


def write_changes(df: DataFrame, table_path: str, version: int, export=None, writer: str = MAIN) -> None:
    """Write one version of aggregate rows, stamped with the version's number in the table's sequence
    (``sequence``) and its first write time (``updated_at``); both stay when the version is written again.

    ``export`` (optional) receives the same stamped rows with exactly the serving
    table's columns, e.g. a JDBC writer for an external OLAP store.  The rows are
    persisted across the two writes, so a stream's micro-batch plan runs once and both
    copies carry the same ``updated_at``.
    """
    spark = df.sparkSession
    own = claim(spark, table_path, writer, int(version))
    stamp = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=own.stamp)
    out = df.withColumns({"updated_at": ntz(stamp), "sequence": F.lit(own.number).cast("bigint")})
    if export is not None:
        out = out.persist()
    try:
        write_sketched(out, f"{table_path}/writer={writer}/version={int(version)}")
        if export is not None:
            export(out.select(*EXPORT_COLUMNS))
    finally:
        if export is not None:
            out.unpersist()


def write_sketched(df: DataFrame, path: str, partition_by: list[str] | None = None, **options) -> None:
    """Write Parquet rows and, taken in the same pass, the sketch of their users."""
    seen = Observation()
    rows = df.observe(seen, *sketch_columns("user_id")) if "user_id" in df.columns else df
    rows.write.mode("overwrite").options(**options).partitionBy(*(partition_by or [])).parquet(path)
    if "user_id" in df.columns:
        write_text(df.sparkSession, f"{path}/_sketch", json.dumps(seen.get))


def read_sketch(spark: SparkSession, path: str) -> dict | None:
    """The sketch beside written rows, or None."""
    text = read_text(spark, f"{path}/_sketch")
    return json.loads(text) if text else None


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def read_text(spark: SparkSession, file: str) -> str | None:
    """A small file's text (None if it is absent)."""
    fs, path = _fs(spark, file)
    if not fs.exists(path(file)):
        return None
    f = fs.open(path(file))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(f, "UTF-8")
    finally:
        f.close()


def write_text(spark: SparkSession, file: str, text: str) -> None:
    fs, path = _fs(spark, file)
    f = fs.create(path(file), True)
    try:
        f.write(bytearray(text, "utf-8"))
    finally:
        f.close()


def read_tag(spark: SparkSession, directory: str, name: str) -> str | None:
    """Value of an empty marker file ``<directory>/_<name>-<value>`` (None if absent).
    File listing of readers skips names that start with ``_`` and hold no ``=``."""
    fs, path = _fs(spark, directory)
    found = fs.globStatus(path(f"{directory}/_{name}-*"))
    return found[0].getPath().getName().rsplit("-", 1)[1] if found else None


def write_tag(spark: SparkSession, directory: str, name: str, value: str) -> None:
    fs, path = _fs(spark, directory)
    fs.mkdirs(path(directory))
    fs.create(path(f"{directory}/_{name}-{value}"), True).close()


def versions(spark: SparkSession, table_path: str, committed: bool = True) -> list[str]:
    """``writer=<id>/version=<n>`` of each version (names from one listing)."""
    fs, path = _fs(spark, table_path)
    found = fs.globStatus(path(f"{table_path}/writer=*/version=*" + ("/_SUCCESS" if committed else ""))) or []
    at = -3 if committed else -2
    return sorted("/".join(st.getPath().toString().split("/")[at:][:2]) for st in found)


def has_history(spark: SparkSession, table_path: str) -> bool:
    """Whether the table ever had rows, removed ones that a compaction holds included."""
    return bool(claims(spark, table_path) or versions(spark, table_path))


def read_changes(spark: SparkSession, table_path: str, schema: StructType | None = None,
                 only: list[str] | None = None) -> DataFrame:
    """The committed versions of the change log (``only`` some of them) with ``writer`` and
    ``version``.  A table without any needs ``schema``."""
    which = versions(spark, table_path) if only is None else only
    own = [StructField("writer", StringType()), StructField("version", LongType())]
    if schema is not None:
        schema = StructType([*(f for f in schema.fields if f.name not in ("writer", "version")), *own])
        if not which:
            return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.option("basePath", table_path).parquet(*(f"{table_path}/{v}" for v in which))
    return df.withColumn("writer", F.col("writer").cast("string")).withColumn("version", F.col("version").cast("long"))


def covered(spark: SparkSession, compacted: str) -> list[str]:
    """The versions a compaction holds."""
    return (read_text(spark, f"{compacted}/_covered") or "").split()


def write_covered(spark: SparkSession, compacted: str, which: list[str]) -> None:
    write_text(spark, f"{compacted}/_covered", "\n".join(which))


def user_splits(spark: SparkSession, compacted: str) -> list[int]:
    """The split points of a compaction's user ranges (none: one range)."""
    return json.loads(read_text(spark, f"{compacted}/_splits") or "[]")


def changes_since(spark: SparkSession, table_path: str, compacted: str, schema: StructType | None = None) -> DataFrame:
    """The rows of a compaction of this table plus the committed versions it doesn't cover:
    all a reader or the next compaction needs, instead of the whole history.  ``yyyymm`` and
    ``user_range`` are kept, as the compaction's partition columns, and worked out for the newer rows."""
    base = spark.read.parquet(compacted).withColumn("version", F.col("version").cast("long"))
    newer = sorted(set(versions(spark, table_path)) - set(covered(spark, compacted)))
    if newer:
        rows = read_changes(spark, table_path, schema, newer).withColumn("yyyymm", yyyymm("window_start"))
        if "user_range" in base.columns:
            rows = rows.withColumn("user_range", range_id(F.col("user_id"), user_splits(spark, compacted), F.col("window_start")))
        base = rows.unionByName(base, allowMissingColumns=True)
    return base


def remove_covered(spark: SparkSession, table_path: str, compacted: str) -> list[str]:
    """Deletes the versions that a compaction covers, rows that it expired included; returns
    them.  To be called when no reader uses the table without the compaction any more.  Their
    claims go too, but for each writer's last one, which a restart may write again."""
    fs, path = _fs(spark, table_path)
    held = set(covered(spark, compacted))
    gone = sorted(held & set(versions(spark, table_path)))
    for v in gone:
        fs.delete(path(f"{table_path}/{v}"), True)
    every = claims(spark, table_path)
    last = {c.writer: c for c in every}
    for c in every:
        if f"writer={c.writer}/version={c.version}" in held and c not in (last[c.writer], every[-1]):
            fs.delete(path(f"{table_path}/_sequence/{c.number:012d}-{c.stamp}-{c.version}-{c.writer}"), False)
    return gone


def read_current(spark: SparkSession, table_path: str, schema: StructType | None = None,
                 compacted: str | None = None, keep_month: bool = False) -> DataFrame:
    """Current rows; with ``compacted`` (a compaction of this table) from ``changes_since``
    rather than the whole history."""
    from actiontally.operators.versions import current_rows  # operators import this module

    if compacted is None:
        return current_rows(read_changes(spark, table_path, schema))
    return current_rows(changes_since(spark, table_path, compacted, schema), keep_month=keep_month)
