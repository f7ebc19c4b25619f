"""Operator 9, n-gram Jaccard join with prefix, length, positional and suffix filters.

Texts with the same set of shingles form one class, found by the set's digest, and the join runs
over classes. Shingles are ordered rarest first. Any one order shared by all documents is right,
so rarity is counted over all documents in hashed buckets (a table of fixed size). Two sets
of similarity t or more share a shingle among their first n - ceil(t n) + 1; prefix rows meet on it.

Large groups of near copies must not meet pair by pair. Each prefix shingle's holders are first
compared with one of them, its pivot; links found join classes to components, and later rounds
(other pivots) compare only across components. A last round compares every pair that is left: in
one shingle's holders, in different components. A pair within one component can't change the
components, so nothing is lost, and a group costs its size, not its square. There the smaller set of
a pair has only its shorter index prefix to offer, and components with many holders of a
shingle meet the others by name, so that their own members never meet. As one link joins two components,
the later pivot rounds hold such members against several pivots, and what stays apart meets only
what whole sketches allow.

The suffix filter has two bounds of how much two sets differ, both from below: differences of the
sizes of parts of the sets, and the bits in which their sketches differ (a bit tells whether
an odd number of the set's shingles fall on it, so every differing shingle turns one bit at most).
"""

from __future__ import annotations

import functools
import itertools
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actiontally.llm.common import arrow_rows, slices, shuffles_freed, small_side, stored, temporary
from actiontally.session import bound_arrow

SHINGLE, PERCENT = 3, 90
#: Bits of the rarity table (2^21 counters) and of the bitmap of shingles held more than once (2^26
#: bits, 8 MB), whatever the corpus' size. A crowded table orders less well and a full bitmap
#: filters less; neither loses a pair.
ORDER_BITS, HELD_BITS = 21, 26
#: Tables added up at once.
TABLES = 64
#: Parts of a set whose sizes the suffix filter compares.
PARTS = 16
#: 64-bit words of a set's sketch.
SKETCH = 8
SKETCH_COLUMNS = [f"s{i}" for i in range(SKETCH)]
#: The first words of it, which the last round's prefix rows carry; all of it is held against the pairs they leave.
SCREEN_COLUMNS = SKETCH_COLUMNS[:3]
#: Holders of a shingle in one component from which on they meet other components by name.
MANY = 32
#: Holders of a shingle from which on pivot rounds after the first compare each with the pivots of all such shingles.
CROWD = 256
#: Rounds of comparisons with pivots before the last, exhaustive one.
PIVOT_ROUNDS = 2
#: Words whose hashes a task remembers.
WORDS_KEPT = 200_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered while they fit."""

    def __missing__(self, w: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(w)
        if len(self) < WORDS_KEPT:
            self[w] = h
        return h


@functools.lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    return WordHashes()


def forget() -> None:
    """At a task's end: its worker stays through the joins that follow, and would hold all this meanwhile."""
    word_hashes.cache_clear()
    pa.default_memory_pool().release_unused()


def shingle_sets(texts: list[bytes | None], k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's k-word shingles; one shingle for a text of fewer words,
    none for a text without."""
    words = [(t or b"").translate(_LOWER).split() for t in texts]
    n = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    total = int(n.sum())
    h = np.fromiter(map(word_hashes().__getitem__, itertools.chain.from_iterable(words)), dtype=np.uint64, count=total)
    roll = h.copy()
    for i in range(1, k):
        roll[: max(0, total - i)] = scramble(roll[: max(0, total - i)] + _ODD) ^ h[i:]
    roll = scramble(roll + _ODD)
    out = []
    for a, m in zip((np.cumsum(n) - n).tolist(), n.tolist()):
        if m >= k:
            out.append(np.unique(roll[a : a + m - k + 1]))
        elif m:
            x = h[a : a + 1]
            for i in range(1, m):
                x = scramble(x + _ODD) ^ h[a + i : a + i + 1]
            out.append(scramble(x + _ODD + np.uint64(m)))
        else:
            out.append(h[:0])
    return out


def digest(s: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``SKETCH`` words per set: the parity of its shingles on each of the bits."""
    bits = 64 * SKETCH
    out = np.zeros((len(sets), bits), dtype=np.uint8)
    for i, s in enumerate(sets):
        out[i] = np.bincount((scramble(s) >> np.uint64(65 - bits.bit_length())).astype(np.int64), minlength=bits) & 1
    return np.packbits(out, axis=1).view("<i8")


def needed(n: int, percent: int) -> int:
    """ceil(percent * n / 100): the least overlap of a set of n with any partner."""
    return -(-percent * n // 100)


def summarise(docs: DataFrame, k: int) -> DataFrame:
    """One pass over the texts: a row per document with its set's size, digest and sketch (``key, n, set, s0, ...``),
    and per task its rarity table (``part, counts``: little-endian 32-bit, deflated)."""
    names = ["key", "n", "set", *SKETCH_COLUMNS, "part", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, kind = np.zeros(1 << ORDER_BITS, dtype=np.int64), None
        for batch, texts in slices(batches, "text"):
            kind, sets = batch.column("key").type, shingle_sets(texts, k)
            found, times = np.unique(np.concatenate(sets) >> np.uint64(64 - ORDER_BITS), return_counts=True)
            counts[found.astype(np.int64)] += times
            m, marks = len(sets), sketches(sets)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(map(len, sets), type=pa.int64()), pa.array(map(digest, sets), type=pa.binary()),
                                              *(pa.array(np.ascontiguousarray(marks[:, i])) for i in range(SKETCH)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary())], names=names)
        if kind is not None:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), *[pa.nulls(1, pa.int64())] * SKETCH,
                                              pa.array([TaskContext.get().partitionId()], type=pa.int64()), pa.array([table_bytes(counts)], type=pa.binary())], names=names)
        forget()

    schema = T.StructType([T.StructField("key", docs.schema["key"].dataType), *T._parse_datatype_string(f"n bigint, set binary, {', '.join(f'{c} bigint' for c in SKETCH_COLUMNS)}, part bigint, counts binary").fields])
    return docs.mapInArrow(run, schema)


def table_bytes(counts: np.ndarray) -> bytes:
    return zlib.compress(np.minimum(counts, 0xFFFFFFFF).astype("<u4").tobytes(), 1)  # small counts: an eighth or less


def table_counts(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), dtype="<u4")


def add_tables(tables: DataFrame) -> np.ndarray:
    """The sum of all tasks' tables, by a tree of sums of at most ``TABLES`` at a time."""
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sums = None, np.zeros(1 << ORDER_BITS, dtype=np.int64)
        for batch in batches:
            for p, c in zip(batch.column("part").to_pylist(), batch.column("counts")):
                if part is not None and p != part:
                    yield pa.RecordBatch.from_arrays([pa.array([part], type=pa.int64()), pa.array([table_bytes(sums)], type=pa.binary())], names=["part", "counts"])
                    sums[:] = 0
                part = p
                sums += table_counts(c.as_buffer())
        if part is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], type=pa.int64()), pa.array([table_bytes(sums)], type=pa.binary())], names=["part", "counts"])

    with arrow_rows(tables.sparkSession, 2):
        while (n := tables.agg(F.count(F.lit(1)), F.max("part")).first())[0] > 1:
            up = tables.withColumn("part", F.floor(F.col("part") / TABLES)).repartition(max(1, int(n[1]) // TABLES + 1), "part")
            tables = stored(up.sortWithinPartitions("part").mapInArrow(total, "part bigint, counts binary"), "rarity")
    got = tables.select("counts").collect()  # one row, of fixed size
    return table_counts(got[0][0]) if got else np.zeros(1 << ORDER_BITS, dtype="<u4")


def of_classes(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """``class, set, text``: the classes' texts by their owners' ids. Rows that share an id bring the
    texts of other classes too; those are told by their digest."""
    own = small_side(classes.select("class", "set", "owner"))
    return texts.join(own, F.col("key").eqNullSafe(F.col("owner"))).select("class", "set", "text")


def class_sets(batch: pa.RecordBatch, texts: list[bytes | None], k: int) -> Iterator[tuple[int, np.ndarray]]:
    for c, want, s in zip(batch.column("class").to_pylist(), batch.column("set").to_pylist(), shingle_sets(texts, k)):
        if digest(s) == want:
            yield c, s


def prefixes(owned: DataFrame, order: np.ndarray, k: int, percent: int) -> DataFrame:
    """``token, class, n, pos, low, high``: the prefix shingles of each class' set with their places
    in it, and the sizes of the set's parts, a byte each (a size above 255 counts as 255, so a
    difference is never overstated). Left out are sets too small for any partner: the closest one
    has a shingle more or less, and n / (n + 1) must reach the similarity."""
    sent = owned.sparkSession.sparkContext.broadcast(order)
    least = -(-percent // (100 - percent)) if percent < 100 else None

    def prefix(s: np.ndarray, rank: np.ndarray) -> np.ndarray:
        first = len(s) - needed(len(s), percent) + 1
        key = rank[(s >> np.uint64(64 - ORDER_BITS)).astype(np.int64)]
        near = np.flatnonzero(key <= np.partition(key, first - 1)[first - 1])
        return s[near[np.lexsort((s[near], key[near]))][:first]]  # ties are ordered by hash, alike in every set

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            own = [(c, s) for c, s in class_sets(batch, texts, k) if least is not None and len(s) >= least]
            if not own:
                continue
            tops = [prefix(s, sent.value) for _, s in own]
            n = np.array([len(t) for t in tops])
            parts = np.stack([np.minimum(np.bincount(((s * _ODD) >> np.uint64(60)).astype(np.int64), minlength=PARTS), 255).astype(np.uint8) for _, s in own])
            halves = np.ascontiguousarray(parts).view("<i8")
            row = np.repeat(np.arange(len(own)), n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (np.concatenate(tops).view(np.int64), np.array([c for c, _ in own])[row], np.array([len(s) for _, s in own])[row],
                                       (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)).astype(np.int32), halves[row, 0], halves[row, 1])],
                names=["token", "class", "n", "pos", "low", "high"])
        forget()

    return owned.mapInArrow(run, "token bigint, class bigint, n bigint, pos int, low bigint, high bigint")


def held_twice(prefix: DataFrame) -> DataFrame:
    """The prefix rows whose shingle more than one row has (and a few others: the bitmap's chance hits)."""
    bit = F.shiftrightunsigned(F.xxhash64("token"), 64 - HELD_BITS)
    words = prefix.groupBy("token").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").groupBy(
        F.shiftrightunsigned(bit, 6).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(F.lit(63)).cast("int"))).alias("bits"))
    got = words.toArrow()  # at most 2^(HELD_BITS - 6) rows
    bitmap = np.zeros(1 << (HELD_BITS - 6), dtype=np.int64)
    bitmap[got["word"].to_numpy()] = got["bits"].to_numpy()
    sent = prefix.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("bit").to_numpy()
            keep = (sent.value[at >> 6] >> (at & 63)) & 1 == 1
            yield batch.select(batch.schema.names[:-1]).filter(pa.array(keep))

    return prefix.withColumn("bit", bit).mapInArrow(run, prefix.schema)


def shingles_of(owned: DataFrame, k: int) -> DataFrame:
    """``class, shingles``: the sorted shingle hashes of each class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            own = [(c, s.tobytes()) for c, s in class_sets(batch, texts, k)]
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in own], type=pa.int64()), pa.array([s for _, s in own], type=pa.binary())],
                                             names=["class", "shingles"])
        forget()

    return owned.mapInArrow(run, "class bigint, shingles binary")


def may_link(percent: int, first_only: bool) -> Column:
    """The length, positional and suffix filters on two prefix rows x and y of one shingle.

    Sizes must allow the similarity. The shingles from the shared one on must suffice for the
    overlap it takes: with ``first_only`` as if the shared one were the first that the sets share
    (true of one of a pair's rows, which is enough where all rows meet), else allowing for shared
    ones ahead of it. And the sizes of the sets' parts bound the number of differing shingles from
    below: that must not exceed what the similarity allows."""
    x, y = F.col("x.n"), F.col("y.n")
    least = F.ceil(F.lit(percent) * (x + y) / F.lit(100 + percent))
    room = F.least(x - F.col("x.pos"), y - F.col("y.pos")) + (F.lit(0) if first_only else F.least("x.pos", "y.pos"))
    part = lambda side, i: F.shiftrightunsigned(F.col(f"{side}.{'low' if i < 8 else 'high'}"), 8 * (i % 8)).bitwiseAND(F.lit(255))
    differ = F.lit(0)
    for i in range(PARTS):
        differ = differ + F.abs(part("x", i) - part("y", i))
    return (F.least(x, y) * 100 >= F.greatest(x, y) * percent) & (room >= least) & (differ <= x + y - 2 * least)


def sketches_near(percent: int, columns: list[str] = SKETCH_COLUMNS) -> Column:
    """Whether the sketches of x and y leave room for the similarity (the suffix filter's second bound).
    Some of their words differ in no more bits than all, so they bound it from below as well."""
    n, differ = F.col("x.n") + F.col("y.n"), F.lit(0)
    for c in columns:
        differ = differ + F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}")))
    return differ <= n - 2 * F.ceil(F.lit(percent) * n / F.lit(100 + percent))


def similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b, linked``: the candidate pairs, verified on the sets themselves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                both = np.concatenate([np.frombuffer(x.as_buffer(), dtype="<u8"), np.frombuffer(y.as_buffer(), dtype="<u8")])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                ok.append(100 * common >= percent * (len(both) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(ok, type=pa.bool_())], names=["a", "b", "linked"])

    one = sets.select(F.col("class").alias("a"), F.col("shingles").alias("x")).join(small_side(pairs.select("a").distinct()), "a", "left_semi")
    two = sets.select(F.col("class").alias("b"), F.col("shingles").alias("y")).join(small_side(pairs.select("b").distinct()), "b", "left_semi")
    # A pivot (b) meets many: its set is joined last and not carried through a shuffle with each pair.
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint, linked boolean")


def components(links: DataFrame) -> DataFrame:
    """``class, comp``: of each linked node the smallest node that links reach, by alternating large
    and small stars until a step changes nothing; each is written to the shared folder. The smallest has no row itself."""
    edges, before = stored(links.filter("a <> b").distinct(), "links"), None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))  # b < a already
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = stored(small.filter("a <> b").distinct(), "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("class"), F.col("b").alias("comp"))
        before = now


def met_by_pivot(rows: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs ``a, b`` to verify among ``rows`` (prefix rows with ``comp``) in a pivot round: each holder of
    shingles with one of its shingles' pivots, and after the first round with all those of shingles that many
    hold, so no more pairs than prefix rows; of different components."""
    by = F.col("class") if turn == 0 else F.xxhash64("class", "token", F.lit(turn))
    pivot = rows.groupBy("token").agg(F.min(F.struct(by.alias("by"), "class", "n", "pos", "low", "high", "comp")).alias("p"),
                                      F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("holders")).filter(
        "lo <> hi").select("token", "p.*", "holders")
    met = rows.alias("x").join(pivot.alias("y"), "token").filter("x.comp <> y.comp").filter(may_link(percent, False))
    each = [F.when(F.col("y.holders") > CROWD, F.col("y.class")).alias("each")] if turn else []
    return met.groupBy(F.col("x.class").alias("a"), *each).agg(F.min(F.struct("y.by", F.col("y.class").alias("b"))).alias("p")).select("a", "p.b")


def met_all(rows: DataFrame, known: DataFrame, percent: int, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Pairs ``a, b`` to verify in the last round: of any two holders of a shingle in different components.

    The smaller set of a pair must hold a shared shingle in its index prefix, n - ceil(2t / (1 + t) n) + 1.
    Holders meet by shingle and band of sizes: sizes within the similarity's ratio lie in one band
    or two neighbouring ones. Where a component has many holders of a shingle, they meet each other component's
    holders by its name instead of by the band."""
    index = F.col("n") - F.ceil(F.lit(2 * percent) * F.col("n") / F.lit(100 + percent)) + 1
    open_ = rows.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("token")
    sizes = rows.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("members"))
    live = rows.join(open_, "token", "left_semi").join(sizes, ["token", "comp"]).join(known.select("class", *SCREEN_COLUMNS), "class").withColumns({
        "short": F.col("pos") < index, "many": F.col("members") > MANY,
        "band": F.floor(F.log(F.col("n").cast("double")) / (1.001 * math.log(100 / percent)))}).drop("members")
    live = keep(live, "open-prefixes")
    smaller = (F.col("y.n") < F.col("x.n")) | ((F.col("y.n") == F.col("x.n")) & (F.col("y.class") < F.col("x.class")))
    rest = (F.col("x.comp") != F.col("y.comp")) & may_link(percent, True) & sketches_near(percent, SCREEN_COLUMNS)
    few = live.filter("not many")
    near = few.filter("short").withColumn("band", F.explode(F.array(F.col("band"), F.col("band") + 1)))
    both = few.alias("x").join(near.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.band") == F.col("y.band")) & smaller & rest)
    pairs = both.select(F.col("x.class").alias("a"), F.col("y.class").alias("b"))
    named = small_side(live.filter("many").select("token", F.col("comp").alias("other")).distinct())
    # Here the rows carry the whole sketch: a group of near copies leaves pairs by the square of its size otherwise.
    crowd = live.join(small_side(named.select("token").distinct()), "token", "left_semi")
    whole = known.join(small_side(crowd.select("class").distinct()), "class", "left_semi").select("class", *SKETCH_COLUMNS[len(SCREEN_COLUMNS):])
    crowd = keep(crowd.join(whole, "class"), "crowded-prefixes")
    # Of two components with many holders the one with the smaller name does the asking.
    asking = crowd.join(named, "token").filter("comp < other or (comp <> other and not many)")
    asked = asking.alias("x").join(crowd.filter("many").alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.other") == F.col("y.comp")) & F.when(
        smaller, F.col("y.short")).otherwise(F.col("x.short")) & rest & sketches_near(percent))
    return near_by_sketch(pairs.distinct(), known, percent).union(asked.select(F.col("x.class").alias("a"), F.col("y.class").alias("b"))).distinct()


def near_by_sketch(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches leave room for the similarity (``known``: ``class, n`` and sketch)."""
    x, y = known.alias("x"), known.alias("y")
    return pairs.join(x, F.col("a") == F.col("x.class")).join(y, F.col("b") == F.col("y.class")).filter(sketches_near(percent)).select("a", "b")


def merged(stars: DataFrame | None, links: DataFrame) -> DataFrame:
    """``class, comp`` after more links: worked out between the components, of which there are few."""
    if stars is None:
        return components(links)
    side = small_side(stars)
    between = links.join(side.alias("p"), F.col("a") == F.col("p.class"), "left").join(side.alias("q"), F.col("b") == F.col("q.class"), "left").select(
        F.coalesce("p.comp", "a").alias("a"), F.coalesce("q.comp", "b").alias("b"))
    new = components(between)
    moved = stars.alias("s").join(small_side(new).alias("t"), F.col("s.comp") == F.col("t.class"), "left").select(
        F.col("s.class").alias("class"), F.coalesce("t.comp", "s.comp").alias("comp"))
    return moved.union(new.join(small_side(stars.select("class")), "class", "left_anti").select("class", "comp"))


def link_classes(texts: DataFrame, classes: DataFrame, order: np.ndarray, shingle: int, percent: int) -> DataFrame | None:
    """``class, comp`` of the classes linked with others, or None if there are none. What only one round
    needs is deleted at its end."""
    spark = texts.sparkSession
    with temporary(spark) as keep:
        with arrow_rows(spark, 2000):
            prefix = keep(prefixes(of_classes(texts, classes), order, shingle, percent), "prefixes")
        rows = stored(held_twice(prefix), "shared-prefixes")
    known = classes.select("class", "n", *SKETCH_COLUMNS)
    stars, tried = None, None
    for turn in [*range(PIVOT_ROUNDS), -1]:
        with temporary(spark) as keep:
            now = rows.withColumn("comp", F.col("class")) if stars is None else rows.join(small_side(stars), "class", "left").withColumn("comp", F.coalesce("comp", "class"))
            pairs = met_all(now, known, percent, keep) if turn < 0 else near_by_sketch(met_by_pivot(now, turn, percent), known, percent).distinct()
            if tried is not None:
                pairs = pairs.join(tried.union(tried.select(F.col("b").alias("a"), F.col("a").alias("b"))), ["a", "b"], "left_anti")
            pairs = stored(pairs, "candidates")
            nodes = pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).distinct()
            with arrow_rows(spark, 2000):
                sets = keep(shingles_of(of_classes(texts, classes.join(small_side(nodes), "class", "left_semi")), shingle), "shingle-sets")
            with arrow_rows(spark, 256):
                done = keep(similar(pairs, sets, percent), "verified")
            tried = pairs if tried is None else tried.union(pairs)
            new = done.filter("linked").select("a", "b")
            if new.limit(1).count():
                stars = stored(merged(stars, new), "stars-so-far")
    return stars


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The id of every row with ``n_shingles`` and ``component_id``, the smallest id its links reach.

    Null text, or text without words: no shingles, linked with nothing, a component by itself. A
    repeated id gives a row each time, and its texts may lie in different components. A null id
    names a component only if no member has another. No rows give none; other columns aren't read,
    whatever their names."""
    if not 50 < percent <= 100:
        raise ValueError("the similarity must be above 50 and at most 100 percent")
    kind = docs.schema[id_col].dataType.simpleString()  # a nested id with all its fields nullable
    texts = docs.select(F.col(id_col).cast(kind).alias("key"), F.col(text_col).cast("string").alias("text"))
    spark = docs.sparkSession
    bound_arrow(spark)
    with shuffles_freed(spark):
        with temporary(spark) as keep, arrow_rows(spark, 2000):
            seen = keep(summarise(texts, shingle), "shingle-summary")
            members = stored(seen.filter("part is null").drop("part", "counts"), "shingle-members")
            order = add_tables(seen.filter("part is not null").select("part", "counts"))
        classes = stored(members.filter("set is not null").groupBy("set").agg(
            F.min("key").alias("owner"), *(F.first(c).alias(c) for c in ["n", *SKETCH_COLUMNS])).withColumn(
            "class", F.monotonically_increasing_id()), "shingle-classes")
        return named_components(members, classes, link_classes(texts, classes, order, shingle, percent), id_col)


def named_components(members: DataFrame, classes: DataFrame, stars: DataFrame | None, id_col: str) -> DataFrame:
    """Each member with the least id of its component; ``stars`` names the components of linked classes."""
    names = classes.select("set", F.col("owner").alias("least"))
    if stars is not None:
        comp = classes.join(stars, "class", "left").select("set", "owner", F.coalesce("comp", "class").alias("comp"))
        names = comp.select("set", "comp").join(comp.groupBy("comp").agg(F.min("owner").alias("least")), "comp").select("set", "least")
    return members.join(names, "set", "left").select(
        F.col("key").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("set").isNull(), F.col("key")).otherwise(F.col("least")).alias("component_id"))


#: DuckDB over ``documents``: all pairs that share a shingle, then reachability.
NEAR_DUPLICATES_SQL = r"""
with recursive w as materialized (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') w from documents),
s as materialized (
  select distinct doc_id, array_to_string(w[i : i + 2], ' ') g from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, least(len(w) + 1, 2)))) i from w)),
n as materialized (select doc_id, count(*) n from s group by doc_id),
common as materialized (select a.doc_id a, b.doc_id b, count(*) c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
links as materialized (
  select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 90 * (x.n + y.n - c)),
both_ways as materialized (select a, b from links union all select b, a from links),
reach as (select doc_id a, doc_id b from documents union select r.a, e.b from reach r join both_ways e on e.a = r.b)
select d.doc_id, coalesce(n.n, 0) n_shingles, r.b component_id from documents d left join n using (doc_id)
join (select a, min(b) b from reach group by a) r on r.a = d.doc_id
"""
