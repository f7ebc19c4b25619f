from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from actiontally.llm import fill_middle as fm
from tests.conftest import SF01


def plain_way(key, text, seed=1):
    """The contract, unit by unit."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n, h = len(units), hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def by_chunks(texts, memo):
    data, starts, ends = fm.joined_bytes(texts)
    bounds = fm.chunk_bounds(data, starts, ends)
    for t, at in zip(texts, bounds):
        yield fm.Text(t, at, memo.of([data[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]))


words = st.lists(st.sampled_from(["ab", "Z", " ", "é", "漢字", "\U0001f600", "\n", "x" * 300, "<", "<S>", "1", "long " * 60]), max_size=40).map("".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(words, min_size=1, max_size=4), st.integers(1, 60))
def test_every_cut_lies_between_units(texts, most):
    old = fm.CHUNK_MOST
    fm.CHUNK_MOST = most
    try:
        for t, x in zip(texts, by_chunks([t.encode() for t in texts], fm.Summaries())):
            units = re.findall(r"[A-Za-z]+|[^A-Za-z]", t)
            assert x.n == len(units)
            for k in {0, 1, x.n // 2, max(0, x.n - 1), x.n} & set(range(x.n + 1)):
                head = "".join(units[:k])
                assert x.cut(k) == (len(head.encode()), len(head))
    finally:
        fm.CHUNK_MOST = old


def test_chunks_depend_on_content_alone():
    rng = np.random.default_rng(1)
    shared = rng.integers(97, 123, 20_000, dtype=np.uint8).tobytes()
    texts = [rng.integers(97, 123, n, dtype=np.uint8).tobytes() + shared for n in (11, 700)]
    data, starts, ends = fm.joined_bytes(texts)
    one, two = ({data[a:b].tobytes() for a, b in zip(at[:-1], at[1:])} for at in fm.chunk_bounds(data, starts, ends))
    assert len(one & two) > 0.9 * len(one)


def test_memo_forgets_and_stays_right(monkeypatch):
    monkeypatch.setattr(fm, "MEMO_BYTES", 100)
    memo = fm.Summaries()
    texts = [f"text {i} of many words ".encode() * 30 for i in range(50)]
    for t in texts:
        (x,) = by_chunks([t], memo)
        assert x.n == len(re.findall(rb"[A-Za-z]+|[^A-Za-z]", t))
    assert memo.size <= 100 + max(map(len, texts))


def rows_of(docs, **how):
    got = fm.fill_in_middle(docs, **how).withColumn("back", fm.restored()).collect()
    return sorted(map(tuple, got), key=repr)


def test_odd_rows(odd_docs, no_docs):
    want = sorted(((k, *plain_way(k, t), t or "") for k, t in odd_docs.select("doc_id", "text").collect()), key=repr)
    assert rows_of(odd_docs) == want
    assert fm.fill_in_middle(no_docs).count() == 0


@pytest.mark.parametrize("seed", [1, 5])
def test_whole_table_restores_exactly(spark, seed):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    marked = docs.select((F.col("doc_id") + 100_000).alias("doc_id"), F.concat("text", F.lit("<"), F.expr("repeat('<S', 1 + doc_id % 3)"), F.lit(">"), "text").alias("text"))
    docs = docs.union(marked.filter("doc_id % 7 = 0"))
    want = sorted(((k, *plain_way(k, t, seed), t) for k, t in docs.collect()), key=repr)
    assert rows_of(docs, seed=seed) == want
