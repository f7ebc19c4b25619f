"""Operator 7, packing: concatenate and cut.

Pass 1 encodes every document where it lies and notes its first id within its partition. The
partition totals' prefix sums are the partitions' global offsets, so pass 2 knows each document's
place in the one long id stream without moving any text: no shuffle. Fixed windows of the stream
are the sequences; a document that crosses a window's end yields one boundary record (piece) per
window. Only the last sequence of the corpus can be short.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actiontally.llm.common import slices, stored
from actiontally.llm.tokens import END_ID, encoder
from actiontally.session import bound_arrow

SEQUENCE = 4096


def encode_documents(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, end_id: int | None = END_ID, keep_memo: bool = True) -> DataFrame:
    """``key, part, start, n_tokens, ids``: ids as little-endian unsigned 32-bit integers, start
    the ids before it in its partition. Null text counts as empty; ids may be null or repeat."""
    bound_arrow(docs.sparkSession)
    end = b"" if end_id is None else np.uint32(end_id).astype("<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, at, part = encoder(vocabulary), 0, TaskContext.get().partitionId()
        for batch, texts in slices(batches, "text"):
            ids = [p + end for p in enc.payloads(texts)]
            n = np.fromiter((len(p) // 4 for p in ids), dtype=np.int64, count=len(ids))
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(np.full(len(n), part, dtype=np.int32)), pa.array(starts), pa.array(n), pa.array(ids, type=pa.binary())],
                names=["key", "part", "start", "n_tokens", "ids"])
        if not keep_memo:
            enc.release()

    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("key", rows.schema["key"].dataType), *T._parse_datatype_string(
        "part int, start bigint, n_tokens bigint, ids binary").fields])
    return rows.mapInArrow(encode, schema)


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
         sequence: int = SEQUENCE, end_id: int = END_ID, keep_memo: bool = True) -> DataFrame:
    """One row per piece: ``key, start, length, ids, doc_tokens, sequence_id, offset, first,
    last`` (whether the piece opens or closes its document).

    Null or empty text: the end id alone. Null and repeated document ids: each row is packed for
    itself. A text of any length is cut into as many pieces as it needs. No rows: no pieces.
    Extra columns are not read. ``keep_memo``: workers keep the encoder's memo for their next task;
    without it each task starts anew and leaves no memory behind."""
    enc = stored(encode_documents(docs, id_col, text_col, vocabulary, end_id, keep_memo), "packed-ids")
    totals = sorted(enc.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())  # a row per partition
    base = dict(zip((r["part"] for r in totals), (np.cumsum([0, *(r["n"] for r in totals)])[:-1]).tolist()))
    offsets = docs.sparkSession.sparkContext.broadcast(base)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                b = batch.slice(a, 256)
                part, start, n = (b.column(c).to_numpy() for c in ("part", "start", "n_tokens"))
                g = start + np.array([offsets.value[p] for p in part.tolist()], dtype=np.int64)
                pieces = np.where(n > 0, (g + n - 1) // sequence - g // sequence + 1, 0)
                row = np.repeat(np.arange(len(n)), pieces)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                seq = g[row] // sequence + nth
                lo = np.maximum(seq * sequence, g[row])
                hi = np.minimum((seq + 1) * sequence, g[row] + n[row])
                ids = b.column("ids").to_pylist()
                cuts = [ids[r][4 * i : 4 * j] for r, i, j in zip(row.tolist(), (lo - g[row]).tolist(), (hi - g[row]).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column("key").take(pa.array(row)), pa.array(lo - g[row]), pa.array(hi - lo), pa.array(cuts, type=pa.binary()),
                     pa.array(n[row]), pa.array(seq), pa.array(lo % sequence), pa.array(nth == 0), pa.array(nth == pieces[row] - 1)],
                    names=["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "first", "last"])

    schema = T.StructType([enc.schema["key"], *T._parse_datatype_string(
        "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, first boolean, last boolean").fields])
    return enc.mapInArrow(cut, schema)


def piece_digest(pieces: DataFrame, id_name: str = "doc_id") -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select(F.col("key").alias(id_name), "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset", "first", "last")
