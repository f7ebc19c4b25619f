"""Helpers shared by the training-data operators.

Texts travel to Python as Arrow strings and are worked on as UTF-8 bytes, so ASCII
character classes need no decoding.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actiontally.session import bound_arrow, scratch_path

#: Ids up to this many may be broadcast; larger sides are shuffled.
BROADCAST_ROWS = 1_000_000
#: Text handled at once inside a task; longer batches are taken in slices of about this size.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names near ``names`` that ``df`` does not have (names clash regardless of case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: computed once, and no
    lineage to recompute when an executor is lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def session_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffles_freed(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """While it holds, the shuffle files of a finished write are deleted at once: for work of many steps,
    each of which is written and read again."""
    return session_setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


@contextlib.contextmanager
def temporary(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Gives a ``stored`` whose tables are deleted at the end: for what a round of work needs no longer
    when its own result is written."""
    made: list[str] = []

    def keep(df: DataFrame, label: str) -> DataFrame:
        made.append(scratch_path(spark, label))
        df.write.parquet(made[-1])
        return spark.read.schema(df.schema).parquet(made[-1])

    try:
        yield keep
    finally:
        for path in made:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def id_mod(col: str | Column, m: int) -> Column:
    """crc32 of the id's text, modulo ``m``; a null id counts as empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % m


def small_side(ids: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``ids`` marked for broadcast if it has at most ``limit`` rows, else left to be shuffled."""
    return F.broadcast(ids) if ids.limit(limit + 1).count() <= limit else ids


def class_sample(rows: DataFrame, id_col: str, class_col: str, quota: int | dict) -> DataFrame:
    """At most about ``quota`` rows of each class (or its own quota, by class), chosen by a hash of the id: the same rows at
    every run and partitioning. The share of a class is quota / its row count, so the sample
    stays bounded however large the table grows."""
    counts = {r[0]: r[1] for r in rows.groupBy(class_col).count().collect()}
    keep = F.lit(False)
    unit = F.pmod(F.xxhash64(F.col(id_col), F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    for k, n in counts.items():
        keep = keep | ((F.col(class_col) == F.lit(k)) & (unit < F.lit((quota if isinstance(quota, int) else quota.get(k, 0)) / n)))
    return rows.filter(keep)


def arrow_rows(spark: SparkSession, rows: int) -> contextlib.AbstractContextManager[None]:
    """While it holds, Python gets at most so many rows at once: for jobs whose rows are large."""
    return session_setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def text_bytes(col: pa.Array) -> list[bytes | None]:
    """The column's texts as UTF-8 bytes."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return col.view(kind).to_pylist()


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Row slices holding about ``limit`` bytes of text each, with the texts as bytes. One longer
    text makes a slice of its own."""
    for batch in batches:
        col = batch.column(column)
        if not batch.num_rows:
            continue
        sizes = np.frombuffer(col.buffers()[1], dtype=np.int64 if pa.types.is_large_string(col.type) else np.int32)
        ends = sizes[col.offset + 1 : col.offset + len(col) + 1].astype(np.int64) - int(sizes[col.offset])
        a = 0
        while a < len(ends):
            base = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, base + limit, side="right")))
            part = batch.slice(a, b - a)
            yield part, text_bytes(part.column(column))
            a = b


#: A-Z to a-z, other ASCII but 0-9 and a-z to a blank; bytes of other characters stay.
WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def arrow_schema(df: DataFrame, extra: str = "") -> T.StructType:
    """The DataFrame's schema followed by the fields of a DDL string."""
    return T.StructType(df.schema.fields + (T._parse_datatype_string(extra).fields if extra else []))


def score_texts(docs: DataFrame, text_col: str, ddl: str, make: Callable[[], Callable[[list[bytes | None]], list[pa.Array]]],
                keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all, if None) and what ``make()``, called once per task, computes from
    each slice of texts: one array per field of ``ddl``. Results whose names the kept columns have
    are put together in a struct named ``found`` (or ``found_`` ...) instead."""
    bound_arrow(docs.sparkSession)
    cols = docs.columns if keep is None else keep
    rows = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(cols)), F.col(text_col).cast("string").alias("text"))
    result = T._parse_datatype_string(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch, texts in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *f(texts)], names=[*batch.schema.names[:-1], *result.fieldNames()])

    out = rows.mapInArrow(run, T.StructType(rows.schema.fields[:-1] + result.fields))
    named = [F.col(f"c{i}").alias(c) for i, c in enumerate(cols)]
    if {c.lower() for c in cols} & {c.lower() for c in result.fieldNames()}:
        return out.select(*named, F.struct(*result.fieldNames()).alias(fresh(docs.select(*cols), "found")[0]))
    return out.select(*named, *result.fieldNames())


def joined_bytes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts' bytes in one array, and where each begins and ends."""
    sizes = np.fromiter((len(t) if t else 0 for t in texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(sizes)
    return np.frombuffer(b"".join(t or b"" for t in texts), dtype=np.uint8), ends - sizes, ends


def segment_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (integers) over [start, end) of each segment."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[ends] - total[starts]
