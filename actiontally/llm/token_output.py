"""Operator 3, token-id binary output with a minimal perfect hash index.

Documents are range-partitioned and sorted by key; each partition is one shard file in the shared
folder, written by one task under a temporary name and then renamed, so a retried task leaves the
same file. A manifest row per shard holds its first global id, so shards need no second pass.

Shard file (little endian)::

    magic 8 | ids: u2 or u4 each | keys: i8 per document (null keys first, then ascending)
    | ends: i8 per document, ids up to and with it | levels: bit words u8, rank samples u4
    | slots: fingerprint u4, first row u4 per distinct key | footer: JSON | footer length u4 | magic 8

The index is a cascade of bit arrays: a key takes the first level on which no other remaining key
shares its bit, and the rank of that bit is its slot: one slot per key, none empty. A slot stores
the key's fingerprint and first row, so a lookup is a few hashes, one popcount and one range read;
an unknown key fails the fingerprint or the key comparison. Rows that repeat a key lie side by
side; the slot names the first.
"""

from __future__ import annotations

import io
import json
import math
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actiontally.llm.common import slices, stored
from actiontally.llm.tokens import END_ID, encoder
from actiontally.session import scratch_path

MAGIC = b"TOKSHRD1"
GAMMA = 2.0
MAX_LEVELS = 64
READ_IDS = 1 << 20


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder's full address: a path without scheme lies where Spark would look for it, on the session's
    default file system, and not on the machine that happens to open it. Local paths stay bare."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    if path.toUri().getScheme() is None:
        path = path.makeQualified(jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(conf), jvm.org.apache.hadoop.fs.Path("/"))
    uri = path.toUri()
    return uri.getPath() if uri.getScheme() == "file" else path.toString()


def open_store(url: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URL, and the path there."""
    return fs.FileSystem.from_uri(url) if "://" in url or url.startswith("file:") else (fs.LocalFileSystem(), url)


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser of key and seed; a bijection for each seed."""
    x = keys.astype(np.uint64) + np.uint64(((2 * seed + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: ``slot(keys)`` is in [0, number of keys)."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # bit words, 64 bits each
        words = np.concatenate(levels) if levels else np.zeros(0, dtype=np.uint64)
        counts = np.bitwise_count(words).astype(np.int64)
        ranks = np.cumsum(counts) - counts
        at = np.cumsum([0, *(len(w) for w in levels)])
        self.ranks = [ranks[i:j] for i, j in zip(at, at[1:])]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, rest = [], keys
        while len(rest):
            if len(levels) == MAX_LEVELS:
                raise ValueError("keys repeat: a perfect hash needs distinct keys")
            size = 64 * max(1, math.ceil(GAMMA * len(rest) / 64))
            pos = (mix(rest, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(pos, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8").astype(np.uint64))
            rest = rest[~alone[pos]]
        return cls(levels)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        """-1 where no level has the key's bit (surely unknown)."""
        out, open_ = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys))
        for lvl, (words, ranks) in enumerate(zip(self.levels, self.ranks)):
            if not len(open_):
                break
            pos = mix(keys[open_], lvl) % np.uint64(64 * len(words))
            word, bit = (pos >> np.uint64(6)).astype(np.int64), pos & np.uint64(63)
            here = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word[here]] & ((np.uint64(1) << bit[here]) - np.uint64(1))
            out[open_[here]] = ranks[word[here]] + np.bitwise_count(below).astype(np.int64)
            open_ = open_[~here]
        return out


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


class ShardWriter:
    def __init__(self, out: Any, width: int):
        self.out, self.width, self.at = out, width, 0
        self.keys: list[int] = []
        self.lengths: list[int] = []
        self.nulls = 0
        self._put(MAGIC)

    def _put(self, b: bytes) -> int:
        self.out.write(b)
        self.at += len(b)
        return self.at

    def add(self, key: int | None, ids: bytes) -> None:
        """ids: little-endian unsigned 32-bit; keys ascend, null ones first."""
        if key is None:
            self.nulls += 1
        self.keys.append(0 if key is None else key)
        self.lengths.append(len(ids) // 4)
        a = np.frombuffer(ids, dtype="<u4")
        if self.width == 2 and len(a) and int(a.max()) > 0xFFFF:
            raise ValueError("an id does not fit two bytes")
        self._put(a.astype(f"<u{self.width}").tobytes())

    def close(self) -> tuple[int, int]:
        """Writes keys, ends, index and footer; documents and ids written."""
        keys, ends = np.array(self.keys, dtype="<i8"), np.cumsum(np.array(self.lengths, dtype="<i8"))
        distinct, first = np.unique(keys[self.nulls:], return_index=True)
        mph = PerfectHash.build(distinct.view(np.uint64))
        slot = mph.slot(distinct.view(np.uint64))
        prints, rows = np.zeros(len(distinct), dtype="<u4"), np.zeros(len(distinct), dtype="<u4")
        prints[slot], rows[slot] = fingerprint(distinct.view(np.uint64)), first + self.nulls
        foot = {"version": 1, "width": self.width, "docs": len(keys), "nulls": self.nulls, "ids": int(ends[-1]) if len(ends) else 0,
                "levels": [len(w) for w in mph.levels], "slots": len(distinct), "at": {"ids": len(MAGIC)}}
        for name, parts in (("keys", [keys]), ("ends", [ends.astype("<i8")]), ("words", [w.astype("<u8") for w in mph.levels]),
                            ("prints", [prints]), ("rows", [rows])):
            foot["at"][name] = self.at
            for p in parts:
                self._put(p.tobytes())
        raw = json.dumps(foot).encode()
        self._put(raw + struct.pack("<I", len(raw)) + MAGIC)
        return foot["docs"], foot["ids"]


class Shard:
    """A shard file opened for keyed access; ids are read by range, never as a whole."""

    def __init__(self, url: str):
        store, path = open_store(url)
        self.f = store.open_input_file(path)
        end = self.f.size()
        tail = self._read(end - 12, 12)
        n, magic = struct.unpack("<I8s", tail)
        if magic != MAGIC or self._read(0, 8) != MAGIC:
            raise ValueError(f"not a whole shard file: {url}")
        self.foot = json.loads(self._read(end - 12 - n, n))
        f = self.foot
        self.keys, self.ends = self._array("keys", "<i8", f["docs"]), self._array("ends", "<i8", f["docs"])
        self.prints, self.rows = self._array("prints", "<u4", f["slots"]), self._array("rows", "<u4", f["slots"])
        words, cut = self._array("words", "<u8", sum(f["levels"])), np.cumsum([0, *f["levels"]])
        self.mph = PerfectHash([words[i:j] for i, j in zip(cut, cut[1:])])

    def _read(self, at: int, n: int) -> bytes:
        self.f.seek(at)
        return self.f.read(n)

    def _array(self, name: str, kind: str, n: int) -> np.ndarray:
        return np.frombuffer(self._read(self.foot["at"][name], n * int(kind[2:])), dtype=kind)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """First row of each key, -1 if the shard does not have it."""
        k = keys.astype(np.int64).view(np.uint64)
        slot = self.mph.slot(k)
        known = slot >= 0
        row = np.full(len(k), -1, dtype=np.int64)
        some = np.flatnonzero(known)
        some = some[self.prints[slot[some]] == fingerprint(k[some])]
        at = self.rows[slot[some]].astype(np.int64)
        same = self.keys[at].astype(np.int64) == keys[some]
        row[some[same]] = at[same]
        return row

    def span(self, row: int) -> tuple[int, int]:
        return (int(self.ends[row - 1]) if row else 0), int(self.ends[row])

    def ids(self, a: int, b: int) -> np.ndarray:
        w = self.foot["width"]
        return np.frombuffer(self._read(self.foot["at"]["ids"] + w * a, w * (b - a)), dtype=f"<u{w}")

    def get(self, key: int) -> np.ndarray | None:
        """The ids of one document, or None."""
        row = int(self.find(np.array([key], dtype=np.int64))[0])
        return None if row < 0 else self.ids(*self.span(row))


def write_shards(docs: DataFrame, folder: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, width: int = 2) -> DataFrame:
    """Writes the shard files and returns the manifest, one row per shard in key order: ``shard,
    url, n_docs, n_ids, start, min_key, max_key`` (start: ids in all shards before it).

    Keys are integers. Null keys come first; repeated keys are ordered by their texts' hash and may
    span shards. Null or empty text is the end id alone. No documents: no shards. A long text is encoded
    and written whole. Extra columns are not read."""
    spark = docs.sparkSession
    folder = qualified(spark, folder)
    store, path = open_store(folder)
    store.create_dir(path)  # on the shared folder; tasks repeat it where it is missing

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(vocabulary), np.uint32(end_id).astype("<u4").tobytes()
        shard, to, w, least, most = TaskContext.get().partitionId(), None, None, None, None
        for batch, texts in slices(batches, "text"):
            if w is None:
                store, path = open_store(folder)
                store.create_dir(path)
                name, tmp = f"{path}/shard-{shard:06d}.bin", f"{path}/.{shard:06d}-{uuid.uuid4().hex[:8]}"
                to = store.open_output_stream(tmp)
                w = ShardWriter(io.BufferedWriter(to, 1 << 20), width)
            keys = batch.column("key").to_pylist()
            for k, ids in zip(keys, enc.payloads(texts)):
                w.add(k, ids + end)
            real = [k for k in (keys[0], keys[-1]) if k is not None]
            least, most = (real[0] if least is None and real else least), (real[-1] if real else most)
        if w is not None:
            n_docs, n_ids = w.close()
            w.out.flush()
            to.close()
            store.move(tmp, name)
            if w.nulls and w.nulls < n_docs:
                least = w.keys[w.nulls]
            yield pa.RecordBatch.from_pylist(
                [{"shard": shard, "url": f"{folder}/shard-{shard:06d}.bin", "n_docs": n_docs, "n_ids": n_ids, "min_key": least, "max_key": most}],
                schema=pa.schema([("shard", pa.int64()), ("url", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
                                  ("min_key", pa.int64()), ("max_key", pa.int64())]))

    rows = docs.select(F.col(id_col).cast("bigint").alias("key"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    done = stored(rows.repartitionByRange(F.col("key").asc_nulls_first(), F.col("tie")).sortWithinPartitions(
        F.col("key").asc_nulls_first(), "tie", "text").select("key", "text").mapInArrow(
        write, "shard bigint, url string, n_docs bigint, n_ids bigint, min_key bigint, max_key bigint"), "shards")
    total, listed = 0, []
    for r in sorted(done.collect()):  # a row per shard
        listed.append((r["shard"], r["url"], r["n_docs"], r["n_ids"], total, r["min_key"], r["max_key"]))
        total += r["n_ids"]
    return spark.createDataFrame(listed, "shard bigint, url string, n_docs bigint, n_ids bigint, start bigint, min_key bigint, max_key bigint")


def read_shards(manifest: DataFrame, id_name: str = "doc_id") -> DataFrame:
    """Every document of the files, found through each shard's index: ``doc_id, start, n_tokens,
    ids_crc32`` plus ``shard`` and ``row``. No document: no rows."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for url, start, shard in zip(*(batch.column(c).to_pylist() for c in ("url", "start", "shard"))):
                s = Shard(url)
                n, nulls = s.foot["docs"], s.foot["nulls"]
                distinct, inverse, counts = np.unique(s.keys[nulls:], return_inverse=True, return_counts=True)
                first = s.find(distinct)
                if (first < 0).any():
                    raise ValueError(f"a key is missing from the index of {url}")
                nth = np.arange(n - nulls) - (np.cumsum(counts) - counts)[inverse]
                rows = np.concatenate([np.arange(nulls), first[inverse] + nth])
                for a in range(0, n, 4096):
                    at = rows[a : a + 4096]
                    lo, hi = np.where(at > 0, s.ends[at - 1], 0), s.ends[at]
                    sums, i = [], 0
                    while i < len(at):  # neighbouring rows are read together, about READ_IDS ids at once
                        j = max(i + 1, int(np.searchsorted(hi, lo[i] + READ_IDS, side="right")))
                        ids, base = s.ids(int(lo[i]), int(hi[j - 1])).astype("<u4"), lo[i]
                        sums += [zlib.crc32(ids[p - base : q - base]) for p, q in zip(lo[i:j], hi[i:j])]
                        i = j
                    keys = pa.array(s.keys[at], type=pa.int64(), mask=at < nulls)
                    yield pa.RecordBatch.from_arrays(
                        [keys, pa.array(start + lo), pa.array(hi - lo), pa.array(sums, type=pa.int64()),
                         pa.array(np.full(len(at), shard)), pa.array(at)], names=[id_name, "start", "n_tokens", "ids_crc32", "shard", "row"])

    shards = max(1, manifest.count())
    return manifest.repartition(shards).mapInArrow(
        read, f"{id_name} bigint, start bigint, n_tokens bigint, ids_crc32 bigint, shard bigint, row bigint")


def lookup(manifest: DataFrame, keys: DataFrame) -> DataFrame:
    """The ids of some documents by key (one column): ``key, ids`` (array of long). Each key meets
    only the shards whose key range covers it; a key that none has gives no row. Of rows that
    repeat a key, each shard returns its first."""
    key = keys.columns[0]
    want = keys.select(F.col(key).cast("bigint").alias("key")).filter("key is not null").distinct()
    met = want.join(F.broadcast(manifest.filter("max_key is not null")), F.col("key").between(F.col("min_key"), F.col("max_key")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        url, s = None, None
        for batch in batches:
            out: dict[str, list] = {"key": [], "ids": []}
            for k, u in zip(batch.column("key").to_pylist(), batch.column("url").to_pylist()):
                if u != url:
                    url, s = u, Shard(u)
                ids = s.get(k)
                if ids is not None:
                    out["key"].append(k)
                    out["ids"].append(ids.tolist())
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("key", pa.int64()), ("ids", pa.list_(pa.int64()))]))

    return met.select("key", "url").repartition("url").sortWithinPartitions("url", "key").mapInArrow(read, "key bigint, ids array<bigint>")


def shard_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "token-shards")
