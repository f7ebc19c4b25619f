from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest

from actiontally.llm import jaccard
from tests.conftest import SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, k, percent):
    """(id, size, component) of each row: all pairs, then reachability."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    least = {r: min((x for x in ids if x is not None), default=None) for r, ids in groups.items()}
    return [(rows[i][0], len(sets[i]), least[root(i)] if sets[i] else rows[i][0]) for i in range(len(rows))]


def got(docs, k, percent):
    out = jaccard.near_duplicates(docs, shingle=k, percent=percent)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    return [tuple(r) for r in out.collect()]


def near_copies(seed, n_groups, members, words, edits):
    rng, out = random.Random(seed), []
    for g in range(n_groups):
        base = [f"g{g}w{rng.randrange(4000)}" for _ in range(words)]
        for _ in range(members):
            w = list(base)
            for _ in range(rng.randrange(edits + 1)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            out.append(" ".join(w))
    rng.shuffle(out)
    return [*enumerate(out)]


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80), (1, 60), (2, 100)])
def test_components_match_brute_force(spark, k, percent):
    rows = near_copies(percent, 12, 9, 120, 6) + [(1000 + i, t) for i, t in enumerate(["a b", "A B", "a b c", "a", "", None, "x " * 40, "x " * 50])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert sorted(got(docs, k, percent), key=str) == sorted(brute(rows, k, percent), key=str)


def test_chains_and_edges_of_the_threshold(spark):
    """Sets of 9 and 10 shingles that differ by one are just similar; a chain joins what its ends alone would not."""
    w = [f"w{i}" for i in range(60)]
    rows = [(5, " ".join(w[:11])), (4, " ".join(w[:12])), (3, " ".join(w[:13])), (2, " ".join(w[:14])), (9, " ".join(w[20:30])), (8, " ".join(w[20:31]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(got(docs, 3, 90)) == sorted(brute(rows, 3, 90))
    assert {c for i, _, c in got(docs, 3, 90) if i < 6} == {2}


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert sorted(got(odd_docs, 3, 90), key=str) == sorted(brute(rows, 3, 90), key=str)
    assert got(no_docs, 3, 90) == []


def test_large_group_of_near_copies_meets_its_pivots_only(spark, monkeypatch):
    seen = []
    real = jaccard.similar
    monkeypatch.setattr(jaccard, "similar", lambda pairs, sets, percent: (seen.append(pairs.count()), real(pairs, sets, percent))[1])
    rows = near_copies(5, 1, 400, 150, 1)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert {c for _, _, c in got(docs, 3, 90)} == {0}
    assert sum(seen) < 400 * 30  # all pairs would be 79,800


def test_other_sizes_of_the_tables_change_nothing(spark, monkeypatch):
    rows = near_copies(7, 6, 8, 100, 5)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = sorted(brute(rows, 3, 90))
    for name, value in (("ORDER_BITS", 4), ("HELD_BITS", 8), ("PIVOT_ROUNDS", 0), ("WORDS_KEPT", 5), ("TABLES", 2), ("MANY", 1), ("MANY", 0)):
        monkeypatch.setattr(jaccard, name, value)
        assert sorted(got(docs, 3, 90)) == want


def test_bits_of_sketches_never_overstate_a_difference():
    rng = random.Random(3)
    for n, d in ((5, 1), (80, 12), (700, 300), (5000, 40)):
        one = [rng.randrange(1 << 64) for _ in range(n)]
        two = one[d // 2 :] + [rng.randrange(1 << 64) for _ in range(d - d // 2)]
        a, b = jaccard.sketches([np.array(sorted(x), dtype=np.uint64) for x in (one, two)])
        differ = sum(bin(int(x) & (1 << 64) - 1).count("1") for x in a ^ b)
        assert differ <= len(set(one) ^ set(two)) and (d > 50 or differ >= d // 2)
    assert not jaccard.sketches([np.array([], dtype=np.uint64)]).any()


def test_unlinked_copies_of_one_passage_make_few_candidates(spark, monkeypatch):
    """Texts that are mostly one passage, too different to link, in the exhaustive round."""
    seen = []
    real = jaccard.similar
    monkeypatch.setattr(jaccard, "similar", lambda pairs, sets, percent: (seen.append(pairs.count()), real(pairs, sets, percent))[1])
    rows = [r for r in near_copies(9, 1, 260, 150, 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert sorted(got(docs, 3, 90)) == sorted(brute(rows, 3, 90))
    assert sum(seen) < 260 * 20  # all pairs would be 33,670


def test_whole_sketches_are_held_against_members_of_large_components(spark, monkeypatch):
    """A large group of near copies, many of them past the threshold: what the last round's joins leave is few."""
    seen = []
    real = jaccard.near_by_sketch
    monkeypatch.setattr(jaccard, "near_by_sketch", lambda pairs, known, percent: (seen.append(pairs.count()), real(pairs, known, percent))[1])
    rows = near_copies(11, 1, 300, 300, 20)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert sorted(got(docs, 3, 90)) == sorted(brute(rows, 3, 90))
    assert seen[-1] < 300 * 4  # all pairs would be 44,850


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert sorted(got(docs, 3, 90)) == sorted(brute(rows, 3, 90))
