"""Operator 12, conversation prefix trie with centroid decomposition.

Each distinct sequence of first turns is a node. A prefix is known by its depth and two 64-bit
digests: exclusive ors of hashes of every turn with its place, so a conversation's prefixes are a
running aggregate, which can be taken in blocks. A node is named by its smallest member, its owner,
and its depth; every conversation's path is the rows (conversation, depth, owner).

Sums over subtrees come from a centroid decomposition of the parent edges. A component's centroid
is its deepest node that has more than half of the component's rows below it; the nodes of which
that is true are just the path from the centroid to the component's top. A round takes every component: the
subtree under its centroid is added up and the sum added along that path, the centroid is done, and
its children's subtrees and what lies above become components of at most half the rows. So rounds grow with the
logarithm of the rows, however deep the trie. Components of at most ``BASE`` rows are left to
tasks that add them up from the bottom.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actiontally.llm.common import small_side, stored

#: A conversation starts with up to MOST_TAKEN turns of the first of its group of GROUP ids.
GROUP, MOST_TAKEN = 5, 8
#: Turn numbers, or depths, of a block: a long conversation is ranked and hashed block by block.
BLOCK_BITS = 10
#: Rows of a component that one task adds up.
BASE = 1024
NO_TURN = -(1 << 60)


def running(rows: DataFrame, over: Window, values: dict[str, tuple[Column, Column, Callable[[str], Column]]]) -> DataFrame:
    """``rows`` (with ``conv`` and ``block``) with running values by name: each a column over the window within the
    block, the aggregate that a whole block amounts to, and the function that adds blocks up. The name
    with ``_ahead`` is what the conversation's earlier blocks amount to, or null."""
    inner = rows.withColumns({k: value.over(over) for k, (value, _, _) in values.items()})
    blocks = rows.groupBy("conv", "block").agg(*(total.alias(k) for k, (_, total, _) in values.items()))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = blocks.select("conv", "block", *(plus(k).over(before).alias(f"{k}_ahead") for k, (_, _, plus) in values.items()))
    later = ahead.filter(F.col(f"{next(iter(values))}_ahead").isNotNull())  # none but for long conversations
    return inner.join(small_side(later), ["conv", "block"], "left")


def rebuilt(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, len, depth, mark, bytes``: the turns of every conversation after its rebuilding, and a row
    of depth 0 for each. ``mark`` is a digest of role and text, ``bytes`` the text's length.

    Turns go by number, null first; turns that share a number go by their digest. Null role or text
    counts as empty. Rows without an id belong to no conversation. Rows that repeat are turns
    each. Texts of any length are taken whole. No rows: none. Other columns aren't read."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.select(F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).cast("bigint").alias("turn"), role.alias("role"), text.alias("text")).filter(
        "conv is not null").select("conv", "turn", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))).alias("mark"),
                                   F.octet_length("text").cast("bigint").alias("bytes"))
    rows = stored(rows.withColumn("block", F.coalesce(F.shiftright("turn", BLOCK_BITS), F.lit(NO_TURN))), "turns")
    order = Window.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "mark")
    ranked = running(rows, order, {"nth": (F.row_number(), F.count(F.lit(1)), F.sum)}).select(
        "conv", (F.col("nth") + F.coalesce("nth_ahead", F.lit(0))).alias("nth"), "mark", "bytes")
    ranked = stored(ranked, "ranked-turns")
    sizes = ranked.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    taken = F.crc32(F.col("conv").cast("string").cast("binary")) % (MOST_TAKEN + 1)
    first = sizes.select(F.col("conv").alias("first"), F.col("n").alias("first_n"))
    convs = stored(sizes.withColumns({"taken": taken, "first": F.col("conv") - F.col("conv") % GROUP}).join(first, "first", "left").select(
        "conv", "first", "taken", F.least("taken", F.coalesce("first_n", F.lit(0))).alias("head"), "n").withColumn(
        "len", F.col("head") + F.greatest(F.col("n") - F.col("taken"), F.lit(0))), "rebuilt-conversations")
    own = ranked.join(convs, "conv").filter("nth > taken").select("conv", "len", (F.col("head") + F.col("nth") - F.col("taken")).alias("depth"), "mark", "bytes")
    heads = ranked.filter((F.col("nth") <= MOST_TAKEN) & (F.col("conv") % GROUP == 0)).withColumnRenamed("conv", "first").join(
        convs.filter("head > 0"), "first").filter("nth <= head").select("conv", "len", F.col("nth").cast("bigint").alias("depth"), "mark", "bytes")
    start = convs.select("conv", "len", F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("binary").alias("mark"), F.lit(0).cast("bigint").alias("bytes"))
    return start.union(heads).union(own)


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv, len, depth, bytes``, the prefix' digests ``a, b`` and its parent's ``pa, pb``, of the turns of depth 1 and more."""
    one, two = F.xxhash64("depth", "mark"), F.xxhash64("mark", F.lit(1), "depth")
    rows = stored(turns.filter("depth > 0").select("conv", "len", "depth", "bytes", one.alias("ha"), two.alias("hb"),
                                                  F.shiftright(F.col("depth") - 1, BLOCK_BITS).alias("block")), "turn-hashes")
    over = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = running(rows, over, {x: (F.bit_xor(f"h{x}"), F.bit_xor(f"h{x}"), F.bit_xor) for x in "ab"})
    a, b = (F.col(x).bitwiseXOR(F.coalesce(f"{x}_ahead", F.lit(0))) for x in "ab")
    return found.select("conv", "len", "depth", "bytes", a.alias("a"), b.alias("b"), a.bitwiseXOR(F.col("ha")).alias("pa"), b.bitwiseXOR(F.col("hb")).alias("pb"))


def trie(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes (``own, depth, pown, n_convs, n_children, below, saved``) and every conversation's path
    (``conv, len, depth, own``). ``below``: rows of paths in the node's subtree."""
    found = stored(prefixes(turns), "prefixes")
    least, n, rows = turns.filter("depth = 0").agg(F.min("conv"), F.count(F.lit(1)), F.sum(F.col("len") + 1)).first()
    spark = turns.sparkSession
    top = spark.createDataFrame([(least, 0, None, n, rows, 0)] if n else [], "own bigint, depth bigint, pown bigint, n_convs bigint, below bigint, saved bigint")
    nodes = stored(found.groupBy("depth", "a", "b").agg(
        F.min("conv").alias("own"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("len") - F.col("depth") + 1).alias("below"),
        ((F.count(F.lit(1)) - 1) * F.max("bytes")).alias("saved"), F.first("pa").alias("pa"), F.first("pb").alias("pb")), "prefix-nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("own").alias("pown"))
    inner = nodes.join(above, ["depth", "pa", "pb"], "left").withColumn("pown", F.when(F.col("depth") == 1, F.lit(least).cast("bigint")).otherwise(F.col("pown")))
    inner = stored(inner.select("a", "b", "own", "depth", "pown", "n_convs", "below", "saved"), "trie-nodes")
    paths = found.select("conv", "len", "depth", "a", "b").join(nodes.select("depth", "a", "b", "own"), ["depth", "a", "b"]).select("conv", "len", "depth", "own")
    paths = stored(paths.union(turns.filter("depth = 0").select("conv", "len", "depth", F.lit(least).cast("bigint"))), "trie-paths")
    every = inner.drop("a", "b").unionByName(top)
    children = every.filter("depth > 0").groupBy(F.col("pown").alias("own"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    return stored(every.join(children, ["own", "depth"], "left").fillna(0, ["n_children"]), "trie"), paths


def centroid_rollup(nodes: DataFrame, paths: DataFrame, sums: list[str], base: int = BASE) -> DataFrame:
    """``own, depth`` and the columns ``sums`` added up over each node's subtree. ``nodes`` has ``own, depth,
    pown, below`` and the columns; ``paths`` the paths that lead to every node."""
    # A conversation that owns no node shares its whole path with one that does.
    owners = paths.filter("depth = len and conv = own").select("conv")
    lean = paths.join(small_side(owners), "conv", "left_semi").select("conv", "depth", "own")
    zero = {f"sum_{c}": F.lit(0).cast("bigint") for c in sums}
    root = nodes.filter("depth = 0").select("own", "below").first()
    top, total = root if root else (None, 0)
    rows = lean.join(nodes.select("own", "depth", "pown", "below", *sums), ["own", "depth"]).withColumns(
        {"top": F.lit(top).cast("bigint"), "top_depth": F.lit(0).cast("bigint"), "total": F.lit(total).cast("bigint"), **zero})
    rows, small, done = stored(rows, "components"), [], []
    comp, heavy, owned = ["top", "top_depth"], F.col("below") * 2 > F.col("total"), F.col("conv") == F.col("own")
    while True:
        small.append(rows.filter(owned & (F.col("total") <= base)).select("own", "depth", "pown", *comp, *sums, *zero))
        rows = rows.filter(F.col("total") > base)
        if not rows.limit(1).count():
            break
        centroid = stored(rows.filter(owned & heavy).groupBy(*comp).agg(
            F.max("depth").alias("z_depth"), F.max_by(F.struct("own", "below"), "depth").alias("z")).select(
            *comp, "z_depth", F.col("z.own").alias("z"), F.col("z.below").alias("z_below")), "centroids")
        met = rows.join(small_side(centroid), comp)
        child = met.filter((F.col("depth") == F.col("z_depth") + 1) & (F.col("pown") == F.col("z"))).select(
            "conv", *comp, F.col("own").alias("child"), F.col("below").alias("child_below"))
        met = stored(met.join(child, ["conv", *comp], "left").withColumns({
            "under": F.col("child").isNotNull() & (F.col("depth") > F.col("z_depth")),
            "is_z": (F.col("depth") == F.col("z_depth")) & (F.col("own") == F.col("z"))}), "split")
        added = stored(met.filter(owned & (F.col("under") | F.col("is_z"))).groupBy(*comp).agg(*(F.sum(c).alias(f"add_{c}") for c in sums)), "centroid-sums")
        met = met.join(small_side(added), comp).withColumns({f"sum_{c}": F.col(f"sum_{c}") + F.when(heavy, F.col(f"add_{c}")).otherwise(0) for c in sums})
        done.append(met.filter(owned & F.col("is_z")).select("own", "depth", *zero))
        rest = met.filter(~F.col("is_z"))
        rows = rest.select(
            "conv", "own", "depth", "pown", *sums, *zero, F.when(heavy, F.col("below") - F.col("z_below")).otherwise(F.col("below")).alias("below"),
            F.when(F.col("under"), F.col("child")).otherwise(F.col("top")).alias("top"),
            F.when(F.col("under"), F.col("z_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
            F.when(F.col("under"), F.col("child_below")).otherwise(F.col("total") - F.col("z_below")).alias("total"))
    parts = [add_up(p, comp, sums) for p in small]
    out = parts[0]
    for p in [*parts[1:], *done]:
        out = out.unionByName(p)
    return out.select("own", "depth", *(F.col(f"sum_{c}").alias(c) for c in sums))


def add_up(rows: DataFrame, comp: list[str], sums: list[str]) -> DataFrame:
    """``own, depth`` and ``sum_*`` plus the sums over the subtree within the component, of components small
    enough for a task. From the deepest node up, each adds what it has to its parent."""
    names = ["own", "depth", "pown", *comp, *sums, *(f"sum_{c}" for c in sums)]
    out = ["own", "depth", *(f"sum_{c}" for c in sums)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting = None, {}
        for batch in batches:
            found = []
            for own, depth, pown, top, top_depth, *values in zip(*(batch.column(c).to_pylist() for c in names)):
                if (top, top_depth) != now:
                    now, waiting = (top, top_depth), {}
                have = waiting.pop((own, depth), None)
                mine = values[: len(sums)]
                if have is not None:
                    mine = [a + b for a, b in zip(mine, have)]
                found.append((own, depth, *(a + b for a, b in zip(mine, values[len(sums) :]))))
                if depth > top_depth:
                    other = waiting.get((pown, depth - 1))
                    waiting[pown, depth - 1] = mine if other is None else [a + b for a, b in zip(mine, other)]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*found)] if found else [pa.array([], pa.int64())] * len(out), names=out)

    dealt = rows.select(*names).repartition(*comp).sortWithinPartitions(*comp, F.col("depth").desc())
    return dealt.mapInArrow(run, ", ".join(f"{c} bigint" for c in out))


def end_digests(paths: DataFrame) -> DataFrame:
    """``own, depth, ends_sha256``: SHA-256 of the ids, ascending and comma-joined, of the conversations that end at a
    node. The hash takes ids one after the other as the sorted rows pass by, so the copies
    of one conversation are never held together; there is one row per conversation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, found = None, None, []
        for batch in batches:
            for own, depth, conv in zip(*(batch.column(c).to_pylist() for c in ("own", "depth", "conv"))):
                if (own, depth) != now:
                    if now is not None:
                        found.append((*now, state.hexdigest()))
                    now, state = (own, depth), hashlib.sha256(b"%d" % conv)
                else:
                    state.update(b",%d" % conv)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["own", "depth", "ends_sha256"])
                found = []
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip((*now, state.hexdigest()))], names=["own", "depth", "ends_sha256"])

    ends = paths.filter("depth = len").select("own", "depth", "conv")
    return ends.repartition("own", "depth").sortWithinPartitions("own", "depth", "conv").mapInArrow(run, "own bigint, depth bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame, base: int = BASE) -> DataFrame:
    """A row per node of the trie of ``turns`` (as ``rebuilt`` gives them): ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Conversations without turns end at the root. Equal conversations share all nodes. No
    conversations: no nodes, not even a root."""
    turns = stored(turns, "rebuilt-turns")
    nodes, paths = trie(turns)
    own = nodes.withColumn("leaves", (F.col("n_children") == 0).cast("bigint"))
    rolled = centroid_rollup(own, paths, ["leaves", "saved"], base)
    none = hashlib.sha256(b"").hexdigest()
    return (nodes.select("own", "depth", "pown", "n_convs", "n_children").join(rolled, ["own", "depth"]).join(end_digests(paths), ["own", "depth"], "left")
            .select(F.col("own").alias("conv_id"), "depth", F.col("pown").alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                    F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")))


#: DuckDB over ``conversations``: every node met with all that its members own below it.
PREFIX_TRIE_SQL = r"""
with t as materialized (
  select conv_id c, coalesce(role, '') role, coalesce(text, '') x, row_number() over (partition by conv_id order by turn nulls first,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) r from conversations where conv_id is not null),
convs as materialized (
  select c, n, xor(4294967295, list_reduce(list_concat([4294967295::bigint], list_transform(range(1, length(c::varchar) + 1), lambda i: ord((c::varchar)[i])::bigint)),
    lambda s, o: list_reduce(list_concat([xor(s, o)], range(8)), lambda v, k: case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end))) % 9 h
  from (select c, count(*) n from t group by c)),
turns as materialized (
  select c.c, t.r d, role, x from convs c join t on t.c = c.c - c.c % 5 and t.r <= c.h
  union all select t.c, t.r - c.h + least(c.h, coalesce(b.n, 0)), role, x from t join convs c on c.c = t.c left join convs b on b.c = c.c - c.c % 5 where t.r > c.h),
paths as materialized (
  select c, 0 d, '' k, '' pk, 0 bytes from convs
  union all select c, d, array_to_string(l, ','), array_to_string(l[:-2], ','), bytes from (
    select c, d, strlen(x) bytes, list(md5(length(role) || ':' || role || x)) over (partition by c order by d) l from turns)),
nodes as materialized (select d, k, any_value(pk) pk, min(c) own, count(*) n, max(bytes) bytes from paths group by d, k),
kids as (select d - 1 d, pk k, count(*) n from nodes where d > 0 group by all),
mine as materialized (
  select n.own c, n.d, case when kids.n is null then 1 else 0 end leaf, (n.n - 1) * n.bytes saved from nodes n left join kids on kids.d = n.d and kids.k = n.k),
rolled as (select p.d, p.k, sum(m.leaf) leaves, sum(m.saved) saved from paths p join mine m on m.c = p.c and m.d >= p.d group by all),
ends as (select p.d, p.k, string_agg(p.c::varchar, ',' order by p.c) ids from paths p join (select c, max(d) d from paths group by c) l on l.c = p.c and l.d = p.d group by all)
select n.own conv_id, n.d::bigint depth, u.own parent_conv_id, n.n n_convs, coalesce(kids.n, 0) n_children, r.leaves::bigint n_leaves, r.saved::bigint saved_tokens,
  sha256(coalesce(e.ids, '')) ends_sha256
from nodes n join rolled r on r.d = n.d and r.k = n.k left join kids on kids.d = n.d and kids.k = n.k left join ends e on e.d = n.d and e.k = n.k
left join nodes u on n.d > 0 and u.d = n.d - 1 and u.k = n.pk
"""
