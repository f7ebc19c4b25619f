from __future__ import annotations

import collections
import zlib

import numpy as np
from tokenizers import Tokenizer

from actiontally.llm import packing, token_lengths, token_output
from tests.conftest import SF001, SF01


def encoded(vocabulary, texts):
    t = Tokenizer.from_file(vocabulary)
    return [np.array([*e.ids, 2], dtype="<u4") for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def rows_of(df):
    return [(r[0], r[1]) for r in df.select("doc_id", "text").collect()]


def check_pieces(pieces, docs, vocabulary, sequence):
    """Every document's ids lie in gapless pieces, and sequences are full but for the last."""
    ids = collections.Counter((k, a.tobytes()) for (k, _), a in zip(docs, encoded(vocabulary, [t for _, t in docs])))
    by = collections.defaultdict(list)
    for p in pieces:
        by[p["sequence_id"]].append(p)
    stream = []
    for s in range(len(by)):
        at = 0
        for p in sorted(by[s], key=lambda p: p["offset"]):
            assert p["offset"] == at and len(p["ids"]) == 4 * p["length"]
            at += p["length"]
            stream.append(p)
        assert at == sequence or s == len(by) - 1
    got, open_ = collections.Counter(), b""
    for p in stream:  # the stream holds documents one after the other
        assert p["first"] == (p["start"] == 0) and p["start"] == len(open_) // 4
        open_ += p["ids"]
        if p["last"]:
            assert p["doc_tokens"] == len(open_) // 4
            got[p["key"], open_] += 1
            open_ = b""
    assert not open_ and got == ids


def test_pieces_hold_every_id_once(spark, vocabulary):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    for sequence in (4096, 1000):
        check_pieces(packing.pack(docs.repartition(5), vocabulary, sequence=sequence).collect(), rows_of(docs), vocabulary, sequence)


def test_odd_rows_are_packed(odd_docs, no_docs, vocabulary):
    check_pieces(packing.pack(odd_docs, vocabulary, sequence=64).collect(), rows_of(odd_docs), vocabulary, 64)
    assert packing.pack(no_docs, vocabulary).count() == 0


def test_shards_round_trip(odd_docs, no_docs, vocabulary, spark, scratch):
    for docs, folder in ((odd_docs, f"{scratch}/a"), (spark.read.parquet(f"{SF01}/documents.parquet"), f"{scratch}/b"), (no_docs, f"{scratch}/c")):
        manifest = token_output.write_shards(docs, folder, vocabulary)
        got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_output.read_shards(manifest).collect())
        rows = rows_of(docs)
        want = collections.Counter((k, len(a), zlib.crc32(a.tobytes())) for (k, _), a in zip(rows, encoded(vocabulary, [t for _, t in rows]))) if rows else {}
        assert collections.Counter((k, n, c) for _, k, n, c in got) == want
        at, last = 0, None
        for start, key, n, _ in got:
            assert start == at and (last is None or key >= last)
            at, last = at + n, key if key is not None else last


def test_keyed_access(spark, scratch, vocabulary):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    manifest = token_output.write_shards(docs.repartition(3), scratch, vocabulary)
    rows = dict(rows_of(docs))
    keys = spark.createDataFrame([(k,) for k in (0, 7, 150, 199, -5, 10**12, None)], "k bigint")
    got = {r["key"]: r["ids"] for r in token_output.lookup(manifest, keys).collect()}
    assert got == {k: encoded(vocabulary, [rows[k]])[0].tolist() for k in (0, 7, 150, 199)}


def test_perfect_hash_is_minimal_and_rejects_strangers():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 2**63, 50_000, dtype=np.uint64))
    mph = token_output.PerfectHash.build(keys)
    assert sorted(mph.slot(keys).tolist()) == list(range(len(keys)))
    assert (token_output.PerfectHash.build(keys[:0]).slot(keys[:5]) == -1).all()


def test_histogram_answers_every_limit(spark, odd_docs, no_docs, vocabulary):
    for docs in (spark.read.parquet(f"{SF01}/documents.parquet"), odd_docs):
        n = np.array([len(a) - 1 for a in encoded(vocabulary, [t for _, t in rows_of(docs)])])
        sums = token_lengths.suffix_sums(token_lengths.length_histogram(docs, vocabulary), block=64).cache()
        for r in sums.collect():
            L = r["length"]
            assert (r["n_docs"], r["docs_longer"], r["tokens_longer"]) == ((n == L).sum(), (n > L).sum(), n[n > L].sum())
            assert r["tokens_truncated"] == np.minimum(n, L).sum() and r["tokens_upto"] == n[n <= L].sum()
        assert token_lengths.truncated_totals(sums, [0, 1, 5, 100, 512, 10**6]) == {L: np.minimum(n, L).sum() for L in (0, 1, 5, 100, 512, 10**6)}
        for q in (0.0, 0.1, 0.5, 0.9, 1.0):
            assert token_lengths.quantile(sums, q) == next(x for x in sorted(n) if (n <= x).mean() >= q)
    empty = token_lengths.suffix_sums(token_lengths.length_histogram(no_docs, vocabulary))
    assert empty.count() == 0 and token_lengths.quantile(empty, 0.5) is None and token_lengths.truncated_totals(empty, [9]) == {9: 0}


def test_folder_lies_on_the_default_file_system(spark):
    """A path without scheme is not the machine's own disk where the session has another file system."""
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    assert token_output.qualified(spark, "/shared/x") == "/shared/x" == token_output.qualified(spark, "file:/shared/x")
    conf.set("fs.defaultFS", "hdfs://name:8020")
    try:
        assert token_output.qualified(spark, "/shared/x") == "hdfs://name:8020/shared/x"
        assert token_output.qualified(spark, "file:/shared/x") == "/shared/x"
        assert token_output.qualified(spark, "s3a://b/x") == "s3a://b/x"
    finally:
        conf.set("fs.defaultFS", before)
