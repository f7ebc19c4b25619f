from __future__ import annotations

import itertools
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from actiontally.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute(text, items, window=10):
    words = WORD.findall(lower(text or ""))
    hit, found = set(), set()
    for item, t in items:
        w = WORD.findall(lower(t or ""))
        for a in range(max(1, len(w) - window + 1) if w else 0):
            win = w[a : a + window]
            for p in range(len(words) - len(win) + 1):
                if words[p : p + len(win)] == win:
                    hit |= set(range(p, p + len(win)))
                    if item is not None:
                        found.add(str(item))
    return len(words), len(hit), sorted(found)


def digest(r):
    return r["n_words"], sum(s["end_word"] - s["first_word"] for s in r["spans"]), r["items"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60))
def test_suffix_array_is_sorted(symbols):
    text = np.array([*symbols, 0])
    marks = iter(range(-len(text), 0))
    unique = [(next(marks), 0) if s == 0 else (1, s) for s in text.tolist()]  # separators differ, by position
    assert d.suffix_array(text).tolist() == sorted(range(len(text)), key=lambda i: unique[i:])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=80), st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=4), min_size=1, max_size=5), st.integers(1, 5))
def test_index_finds_every_occurrence(symbols, phrases, sample):
    text = np.array([*symbols, 0])
    index = d.FMIndex(text, 6, sample)
    m = np.zeros((len(phrases), 4), dtype=np.int64)
    for i, p in enumerate(phrases):
        m[i, 4 - len(p):] = p
    lo, hi = index.search(m, np.array([len(p) for p in phrases]))
    for p, a, b in zip(phrases, lo, hi):
        want = [i for i in range(len(text)) if text[i : i + len(p)].tolist() == p]
        assert (sorted(index.locate(np.arange(a, b)).tolist()) if b > a else []) == want


ITEMS = [(1, "The quick brown fox jumps over the lazy dog"), (2, " ".join(f"w{i}" for i in range(14))), (3, "quick brown"), (4, ""), (5, None),
         (6, "...!"), (None, "no id here"), (7, "漢字 quoted"), (8, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12")]


def test_odd_rows_and_items(spark, odd_docs, no_docs):
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string").selectExpr("*", "'own' as spans")
    more = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame(
        [(10, "a w1 " + " ".join(f"W{i}" for i in range(14)) + " w3"), (11, "w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12")], "doc_id bigint, text string"))
    got = d.contamination(more, bench).collect()
    assert len(got) == more.count()
    for r in got:
        assert digest(r) == brute(r["text"], ITEMS)
        for s in r["spans"]:
            w = WORD.findall(lower(r["text"]))[s["first_word"] : s["end_word"]]
            assert WORD.findall(lower(r["text"][s["start"] : s["end"]])) == w
    clash = d.contamination(odd_docs, bench)
    assert clash.columns == [*odd_docs.columns, "found_"] and clash.filter("size(found_.spans) > 0").count() == 3
    assert d.contamination(no_docs, bench).count() == 0
    assert d.contamination(odd_docs.select("doc_id", "text"), bench.filter("false")).filter("size(spans) > 0").count() == 0


def test_blocks_of_items_give_the_same(spark, odd_docs, monkeypatch):
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = odd_docs.select("doc_id", "text")

    one = sorted(map(tuple, d.contamination(docs, bench, clean=True).collect()), key=str)
    monkeypatch.setattr(d, "BLOCK_CHARS", 40)
    assert len(list(d.blocks(bench, "item_id", "text", 10))) > 1
    many = sorted(map(tuple, d.contamination(docs, bench, clean=True).collect()), key=str)
    assert [r[2:] for r in one] == [r[2:] for r in many] and [r[:2] for r in one] == [r[:2] for r in many]


def test_cleaned_texts_lose_the_spans_only(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "é Alpha, beta; gamma! ü alpha beta gamma"), (2, "alpha beta")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["text"] for r in d.contamination(docs, bench, clean=True).collect()}
    assert got == {1: "é ! ü ", 2: "alpha beta"}


def test_small_shards_give_the_same(spark, odd_docs, monkeypatch):
    shards = d.Shard(d.Phrases([("1", "a b c"), ("2", "c a b c")], 3))
    texts = [b"a b c a b c", None, b"x c a b c", b"a b", b"c"]
    import pyarrow as pa

    shards.add(pa.RecordBatch.from_pydict({"x": [1] * 5}), texts)
    spans, items = shards.hits()
    for i, t in enumerate(texts):
        n, hit, found = brute((t or b"").decode(), [("1", "a b c"), ("2", "c a b c")], 3)
        assert sum(b - a for a, b in spans.get(i, [])) == hit and items.get(i, []) == found
    assert list(itertools.chain(*spans.values()))
