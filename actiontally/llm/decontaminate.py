"""Operator 2, benchmark decontamination by an FM-index per training shard.

Test phrases are the benchmark items' windows of ten words. A shard is a run of documents within
one task (bounded in bytes); its text over the phrases' alphabet is indexed: a word that no phrase
has can't lie inside an occurrence, so all such words are one separator, and stretches between
separators shorter than the shortest phrase need no place in the index. Phrases are searched
backwards, all at once, by ranks in a wavelet matrix of the Burrows-Wheeler transform; occurrences
are located by walking to sampled suffix positions; overlapping ones are merged to removal spans.

The phrases are the only thing sent to the tasks, in blocks of bounded size; documents never move.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actiontally.llm.common import WORD_BYTES, fresh, slices, stored
from actiontally.session import bound_arrow

WINDOW = 10
#: A shard's texts, in bytes (a longer text is a shard of its own).
SHARD_BYTES = 24 << 20
#: Benchmark characters per block of phrases; more items are searched block after block.
BLOCK_CHARS = 16 << 20
#: Distance of sampled suffix positions.
SAMPLE = 16
_RUN = re.compile(rb"[^ ]+")


class Bits:
    """Bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        pad = np.zeros((len(bits) // 64 + 1) * 64, dtype=bool)
        pad[: len(bits)] = bits
        self.words = np.packbits(pad, bitorder="little").view("<u8")
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        w, below = i >> 6, (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.ranks[w] + np.bitwise_count(self.words[w] & below)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1


class WaveletMatrix:
    """Ranks of symbols in a sequence: one bit vector per binary digit, stably parted by it."""

    def __init__(self, seq: np.ndarray, symbols: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for digit in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            ones = (seq >> digit) & 1 == 1
            self.levels.append((digit, Bits(ones), int(len(seq) - ones.sum())))
            seq = np.concatenate([seq[~ones], seq[ones]])
        self.first = self._down(np.arange(symbols), np.zeros(symbols, dtype=np.int64))

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for digit, bits, zeros in self.levels:
            one = (c >> digit) & 1 == 1
            r = bits.rank(i)
            i = np.where(one, zeros + r, i - r)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of symbol c before position i."""
        return self._down(c, i) - self.first[c]

    def symbol_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at i and how often it occurs before i."""
        c = np.zeros(len(i), dtype=np.int64)
        for digit, bits, zeros in self.levels:
            one = bits.get(i)
            r = bits.rank(i)
            i = np.where(one, zeros + r, i - r)
            c |= one.astype(np.int64) << digit
        return c, i - self.first[c]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order; each separator (0) counts as a symbol of its own, ordered by position.
    Prefix doubling that sorts anew only the suffixes whose order is still open."""
    n, sep = len(text), text == 0
    key = np.where(sep, np.cumsum(sep) - 1, text + int(sep.sum()))
    sa = np.argsort(key, kind="stable")
    sorted_key = key[sa]
    head = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    rank = np.empty(n, dtype=np.int64)
    rank[sa] = np.maximum.accumulate(np.where(head, np.arange(n), 0))  # a group's rank: where it begins
    open_ = np.flatnonzero(~(head & np.concatenate([head[1:], [True]])))
    k = 1
    while len(open_):
        some = sa[open_]  # whole groups, in order
        nxt = rank[np.minimum(some + k, n - 1)]
        order = np.argsort(rank[some] * n + nxt, kind="stable")
        some, nxt = some[order], nxt[order]
        sa[open_] = some
        g = rank[some]
        head = np.concatenate([[True], (g[1:] != g[:-1]) | (nxt[1:] != nxt[:-1])])
        rank[some] = np.maximum.accumulate(np.where(head, open_, 0))
        open_ = open_[~(head & np.concatenate([head[1:], [True]]))]
        k *= 2
    return sa


class FMIndex:
    """Index of a symbol sequence whose last symbol is a separator (0)."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = SAMPLE):
        sa = suffix_array(text)
        self.n = len(text)
        self.bwt = WaveletMatrix(text[sa - 1], symbols)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        # Positions after a separator are sampled too, so no walk crosses one.
        starts = np.concatenate([[True], text[:-1] == 0])
        marked = (sa % sample == 0) | starts[sa]
        self.marked, self.samples = Bits(marked), sa[marked]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of the suffixes that begin with each phrase. Phrases are the rows of
        a matrix, right-aligned."""
        lo, hi = np.zeros(len(phrases), dtype=np.int64), np.full(len(phrases), self.n, dtype=np.int64)
        live = np.arange(len(phrases))
        for step in range(phrases.shape[1]):
            live = live[(lengths[live] > step) & (lo[live] < hi[live])]
            if not len(live):
                break
            c = phrases[live, phrases.shape[1] - 1 - step]
            lo[live] = self.before[c] + self.bwt.rank(c, lo[live])
            hi[live] = self.before[c] + self.bwt.rank(c, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows."""
        out, walk, row, steps = np.empty(len(rows), dtype=np.int64), np.arange(len(rows)), rows, 0
        while len(walk):
            known = self.marked.get(row)
            out[walk[known]] = self.samples[self.marked.rank(row[known])] + steps
            walk, row = walk[~known], row[~known]
            c, r = self.bwt.symbol_rank(row)
            row, steps = self.before[c] + r, steps + 1
        return out


class Phrases:
    """A block of benchmark items as distinct word windows."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        rows: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in text.encode().translate(WORD_BYTES).split()]
            for a in range(max(1, len(ids) - window + 1) if ids else 0):
                owners = rows.setdefault(tuple(ids[a : a + window]), set())
                if item is not None:
                    owners.add(item)
        self.lengths = np.array([len(r) for r in rows], dtype=np.int64)
        self.matrix = np.zeros((len(rows), window), dtype=np.int64)
        for i, r in enumerate(rows):
            self.matrix[i, window - len(r):] = r
        names = sorted({i for o in rows.values() for i in o})
        at = {n: i for i, n in enumerate(names)}
        self.names = names
        self.owners = [np.array(sorted(at[i] for i in o), dtype=np.int64) for o in rows.values()]
        self.shortest = int(self.lengths.min()) if len(rows) else 0


class Shard:
    """Documents gathered for one index."""

    def __init__(self, phrases: Phrases):
        self.p, self.size, self.docs = phrases, 0, 0
        self.words: list[np.ndarray] = []
        self.text: list[np.ndarray] = []
        self.doc: list[np.ndarray] = []
        self.at: list[np.ndarray] = []
        self.kept: list[tuple[pa.RecordBatch, list[bytes | None]]] = []

    def add(self, batch: pa.RecordBatch, texts: list[bytes | None]) -> None:
        self.kept.append((batch, texts))
        self.size += sum(len(t) for t in texts if t)
        split = [(t or b"").translate(WORD_BYTES).split() for t in texts]
        n = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        self.words.append(n)
        total = int(n.sum())
        ids = np.fromiter(map(self.p.vocabulary.get, itertools.chain.from_iterable(split), itertools.repeat(0)), dtype=np.int64, count=total)
        known = np.flatnonzero(ids)
        if self.p.shortest and len(known):
            doc = np.repeat(np.arange(len(n)), n)[known]
            new = np.concatenate([[True], (known[1:] != known[:-1] + 1) | (doc[1:] != doc[:-1])])
            run = np.cumsum(new) - 1
            keep = np.bincount(run)[run] >= self.p.shortest
            known, doc, run = known[keep], doc[keep], run[keep]
            if len(known):
                place = np.arange(len(known)) + np.cumsum(np.concatenate([[False], run[1:] != run[:-1]]))
                size = int(place[-1]) + 2
                text, docs, at = (np.zeros(size, dtype=np.int64) for _ in range(3))
                text[place], docs[place] = ids[known], doc + self.docs
                at[place] = known - (np.cumsum(n) - n)[doc]
                self.text.append(text)
                self.doc.append(docs)
                self.at.append(at)
        self.docs += len(texts)

    def hits(self) -> tuple[dict[int, list[tuple[int, int]]], dict[int, list[str]]]:
        """Per document: merged spans of hit words, and items with occurrences."""
        if not self.text:
            return {}, {}
        text, doc, at = (np.concatenate(x) for x in (self.text, self.doc, self.at))
        index = FMIndex(text, len(self.p.vocabulary) + 1)
        lo, hi = index.search(self.p.matrix, self.p.lengths)
        found = np.flatnonzero(hi > lo)
        if not len(found):
            return {}, {}
        n = hi[found] - lo[found]
        phrase = np.repeat(found, n)
        pos = index.locate(np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[found], n))
        edge = np.bincount(pos, minlength=len(text) + 1) - np.bincount(pos + self.p.lengths[phrase], minlength=len(text) + 1)
        hit = np.flatnonzero(np.cumsum(edge)[:-1] > 0)
        d, w = doc[hit], at[hit]
        new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (w[1:] != w[:-1] + 1)]))
        spans: dict[int, list[tuple[int, int]]] = {}
        for i, j in zip(new.tolist(), [*(new[1:] - 1).tolist(), len(d) - 1]):
            spans.setdefault(int(d[i]), []).append((int(w[i]), int(w[j]) + 1))
        pairs = np.unique(np.stack([doc[pos], phrase]), axis=1)
        items: dict[int, set[str]] = {}
        for x, p in zip(*pairs.tolist()):
            items.setdefault(x, set()).update(self.p.names[i] for i in self.p.owners[p].tolist())
        return spans, {k: sorted(v) for k, v in items.items()}


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def byte_spans(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word spans as byte spans, from the first word's start to the last one's end."""
    at = [m.span() for m in _RUN.finditer(text.translate(WORD_BYTES))]
    return [(at[a][0], at[b - 1][1]) for a, b in spans]


SPANS = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))
RESULT = ("n_words bigint, spans array<struct<first_word: bigint, end_word: bigint, start: bigint, end: bigint>>, items array<string>")


def blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> Iterator[tuple[Phrases, bool]]:
    """The items' phrases, in as many blocks as their size asks for (one where it is small), each made when
    it is asked for, and whether it is the last."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    n = max(1, math.ceil((rows.agg(F.sum(F.length("text"))).first()[0] or 0) / BLOCK_CHARS))
    for b in range(n):
        yield Phrases([tuple(r) for r in rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b).collect()], window), b == n - 1


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, keep: list[str] | None = None, clean: bool = False) -> DataFrame:
    """The columns ``keep`` of each document (all, if None) with ``n_words, spans, items``: spans of
    hit words (word positions and code points, merged) and the ids of items found, sorted as text.
    With ``clean``, the spans are cut out of the kept text.

    Null text: no words, no spans, stays null. Items without words match nothing; several items with
    equal windows are all reported; an item without id marks words but isn't reported. Repeated
    documents are each judged. No documents: no rows; an empty benchmark: no spans. A text longer than a
    shard is a shard of its own, indexed whole. A benchmark of several blocks is searched one block
    after the other, with the documents and what was found written in between, so that the driver and
    a task hold one block at a time. Kept columns may be named like the results: they
    win, and the results are in a struct, ``found`` (``found_`` if taken)."""
    spark, cols = docs.sparkSession, docs.columns if keep is None else keep
    bound_arrow(spark)
    some = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(cols)), F.col(text_col).cast("string").alias("text"))
    out, own = some, cols.index(text_col) if clean else -1
    for b, (phrases, last) in enumerate(blocks(benchmark, item_col, item_text, window)):
        sent = spark.sparkContext.broadcast(phrases)
        del phrases
        out = out.mapInArrow(_search(sent, b > 0, last, own), T.StructType(
            [f for f in some.schema.fields if f.name != "text" or not last] + T._parse_datatype_string(RESULT).fields))
        if not last:
            out = stored(out, f"phrases-{b}")
            sent.destroy()
    names = T._parse_datatype_string(RESULT).fieldNames()
    if {c.lower() for c in cols} & set(names):
        return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(cols)), F.struct(*names).alias(fresh(docs.select(*cols), "found")[0]))
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(cols)), *names)


def _search(sent, again: bool, last: bool, own: int):  # noqa: ANN001, ANN202
    def emit(shard: Shard) -> Iterator[pa.RecordBatch]:
        spans, items = shard.hits()
        d = 0
        for (batch, texts), n in zip(shard.kept, shard.words):
            k = range(d, d + len(texts))
            s, f = [spans.get(i, []) for i in k], [items.get(i, []) for i in k]
            if again:
                old = batch.column("spans").to_pylist()
                s = [merge(x + [(o["first_word"], o["end_word"]) for o in y]) for x, y in zip(s, old)]
                f = [sorted({*x, *y}) for x, y in zip(f, batch.column("items").to_pylist())]
            rows, cut = [], {}
            for i, (t, x) in enumerate(zip(texts, s)):
                row = []
                if x:
                    raw = byte_spans(t, x)
                    marks = [p for ab in raw for p in ab]  # code points before each, counted once along the text
                    at = np.cumsum([len(t[a:b].decode("utf-8", "replace")) for a, b in zip([0, *marks], marks)]).tolist()
                    row = [(a, b, at[2 * j], at[2 * j + 1]) for j, (a, b) in enumerate(x)]
                    if last and own >= 0:
                        keep = [0, *marks, len(t)]
                        cut[i] = b"".join(t[keep[j] : keep[j + 1]] for j in range(0, len(keep), 2))
                rows.append(row)
            cols = {c: batch.column(c) for c in batch.schema.names if c not in ("n_words", "spans", "items") and (c != "text" or not last)}
            if cut:
                cols[f"c{own}"] = pa.array([cut.get(i, t) for i, t in enumerate(texts)], type=pa.binary()).cast(pa.string())
            structs = pa.array([[dict(zip(("first_word", "end_word", "start", "end"), r)) for r in row] for row in rows], type=SPANS)
            cols |= {"n_words": pa.array(n), "spans": structs, "items": pa.array(f, type=pa.list_(pa.string()))}
            yield pa.RecordBatch.from_pydict(cols)
            d += len(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(sent.value)
        for batch, texts in slices(batches, "text"):
            shard.add(batch, texts)
            if shard.size >= SHARD_BYTES:
                yield from emit(shard)
                shard = Shard(sent.value)
        if shard.kept:
            yield from emit(shard)

    return run


def contamination_digest(found: DataFrame) -> DataFrame:
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end_word"] - s["first_word"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def item_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


#: DuckDB over ``documents`` and ``benchmark``; RE2 classes count code points, so the word class names its upper end.
CONTAMINATION_SQL = r"""
with words as (
  select doc_id, unnest(w) word, unnest(range(len(w))) p from
    (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') w from documents)),
items as (
  select item_id, w, len(w) n from
    (select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') w from benchmark)
  where len(w) > 0),
starts as (select item_id, w, least(n, 10) len, unnest(range(greatest(1, n - 9))) a from items),
windows as (select distinct item_id, len, array_to_string(w[a + 1 : a + len], ' ') win from starts),
sizes as (select distinct len from windows),
lists as (select doc_id, list(word order by p) w from words group by doc_id),
grams as (select doc_id, len, unnest(range(greatest(0, len(w) - len + 1))) p, w from lists, sizes),
occ as (select distinct g.doc_id, g.p, g.len, x.item_id from (select doc_id, len, p, array_to_string(w[p + 1 : p + len], ' ') win from grams) g
        join windows x on x.len = g.len and x.win = g.win),
hit as (select doc_id, count(distinct p) n from (select doc_id, unnest(range(p, p + len)) p from occ) group by doc_id),
its as (select doc_id, count(*) n, string_agg(i, ',' order by i) l from (select distinct doc_id, cast(item_id as varchar) i from occ) group by doc_id)
select d.doc_id, coalesce(len(l.w), 0) n_words, coalesce(h.n, 0) n_hit, coalesce(i.n, 0) n_items, sha256(coalesce(i.l, '')) items_sha256,
       coalesce(h.n, 0) > 0 contaminated
from documents d left join lists l using (doc_id) left join hit h using (doc_id) left join its i using (doc_id)
"""
