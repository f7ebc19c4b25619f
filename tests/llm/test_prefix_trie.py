from __future__ import annotations

import collections
import hashlib
import random
import zlib

import pytest

from actiontally.llm import prefix_trie as p

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain_way(rows):
    """The contract over dictionaries: every rebuilt conversation against every prefix."""
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    for c, turns in own.items():
        turns.sort(key=lambda t: (t[0], t[1], hashlib.md5(f"{len(t[2])}:{t[2]}{t[3]}".encode()).digest()))
        own[c] = [t[2:] for t in turns]
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        full[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, turns in sorted(full.items()):
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = collections.Counter(n[:-1] for n in members if n)
    leaves, saved = collections.Counter(), collections.Counter()
    for n, who in members.items():
        bytes_ = len(n[-1][1].encode()) if n else 0
        for d in range(len(n) + 1):
            leaves[n[:d]] += not children[n]
            saved[n[:d]] += (len(who) - 1) * bytes_
    return sorted((min(who), len(n), min(members[n[:-1]]) if n else None, len(who), children[n], leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest()) for n, who in members.items())


def trie_of(spark, rows, base=p.BASE, parts=3):
    found = p.prefix_trie(p.rebuilt(spark.createDataFrame(rows, SCHEMA).repartition(parts)), base)
    assert found.columns == COLUMNS
    return sorted(tuple(r) for r in found.collect())


def made(seed, convs, turns, vocabulary):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]), rng.choice(vocabulary)) for c in range(convs) for t in range(rng.randint(1, turns))]


ODD = [(None, 1, "user", "no id"), (0, 2, None, "é漢"), (0, None, "user", None), (0, 1, "user", "a"), (0, 1, "user", "a"), (0, 1, "bot", "b"),
       (3, 5, "user", "x"), (4, 0, "", ""), (4, 0, None, None), (7, 1, "user", "alone " * 5000), (25, 1, "a", "1"), (26, 9, "a", "2"), (27, -4, "1:a", ""), (27, -3, "1", "a")]


def test_odd_rows(spark):
    assert trie_of(spark, ODD) == plain_way(ODD)
    wide = spark.createDataFrame(ODD, SCHEMA)
    for name in ("conv", "nth", "mark", "len", "depth", "own", "top", "a", "block", "bytes"):
        wide = wide.selectExpr("*", f"'own' as `{name}`")
    assert sorted(tuple(r) for r in p.prefix_trie(p.rebuilt(wide)).collect()) == plain_way(ODD)
    assert trie_of(spark, [], parts=1) == [] and trie_of(spark, [(None, 1, "user", "x")]) == []


@pytest.mark.parametrize("base", [1, 3])
def test_components_split_down_to_single_nodes(spark, base):
    rows = made(2, 60, 12, ["yes", "no"]) + [(100, t, "user", "deep") for t in range(40)] + [(101, t, "user", "deep") for t in range(37)]
    assert trie_of(spark, rows, base) == plain_way(rows)


def test_long_conversations_are_worked_on_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(p, "BLOCK_BITS", 2)
    rows = made(4, 20, 25, ["a", "b"]) + [(40, None, "user", str(i % 3)) for i in range(9)] + [(41, 3, "x", str(i)) for i in range(9)]
    assert trie_of(spark, rows, 20) == plain_way(rows)


def test_a_third_of_the_conversations_alike(spark):
    rows = made(5, 90, 4, ["a", "b", "c"]) + [(c, t, "user", f"same {t}") for c in range(1000, 1300, 5) for t in range(12)]
    assert trie_of(spark, rows, 50) == plain_way(rows)


def test_rounds_follow_the_logarithm_of_a_chain(spark, monkeypatch):
    rounds, keep = [], p.stored

    def counted(df, label):
        rounds.append(label)
        return keep(df, label)

    monkeypatch.setattr(p, "stored", counted)
    rows = [(5, t, "user", "on") for t in range(300)]
    assert trie_of(spark, rows, 20) == plain_way(rows)
    assert rounds.count("centroids") <= 6
