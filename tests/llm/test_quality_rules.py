from __future__ import annotations

import collections
import math
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from actiontally.llm import quality_rules as q
from tests.conftest import SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = collections.Counter(zip(w, w[1:], w[2:]))
    hit = {j for i in range(len(w) - 2) if seen[w[i], w[i + 1], w[i + 2]] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def brute_ratios(rows, trusted):
    def bucket(g):
        return ((g[0] * 257 + g[1]) * 257 + g[2]) * 0x9E3779B1 % 2**32 >> 16

    raw, good = collections.Counter(), collections.Counter()
    for k, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 2):
            raw[bucket(b[i : i + 3])] += 1
            if k in trusted:
                good[bucket(b[i : i + 3])] += 1
    n_raw, n_good = sum(raw.values()), sum(good.values())

    def score(text):
        b = (text or "").encode()
        hs = [bucket(b[i : i + 3]) for i in range(len(b) - 2)]
        if not hs or not n_good:
            return 0.0
        return sum(round((math.log((good[h] + 1) / (n_good + 65536)) - math.log((raw[h] + 1) / (n_raw + 65536))) * 65536) for h in hs) / 65536 / len(hs)

    return score


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t#é漢 "), st.text()), max_size=8))
def test_counts_match_brute_force(texts):
    c = q.text_counts([None if t is None else t.encode("utf-8", "surrogatepass") for t in texts])
    assert [tuple(int(c[n][i]) for n in c) for i in range(len(texts))] == [brute_counts(t) for t in texts]


def compare(docs, trusted_rows, spark):
    trusted = spark.createDataFrame([(k,) for k in trusted_rows], "doc_id bigint")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    score = brute_ratios(rows, set(trusted_rows) - {None})
    out = q.rate(docs.select("doc_id", "text"), q.fit(docs, trusted)).collect()
    assert len(out) == len(rows)
    for r in out:
        n = brute_counts(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == n
        assert r["base_failed"] == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert abs(r["llr"] - score(r["text"])) < 1e-9
        assert r["kept"] == (not r["base_failed"] and r["llr"] >= q.THRESHOLD)


def test_verdicts_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").repartition(3)
    good = [r[0] for r in spark.read.parquet(f"{SF001}/labels.parquet").filter("quality = 1").select("doc_id").collect()]
    compare(docs, good, spark)


def test_odd_rows(spark, odd_docs, no_docs):
    compare(odd_docs, [1, 1, None, 7, 99], spark)
    compare(odd_docs, [], spark)
    wide = q.rate(odd_docs, np.zeros(1 << 16, dtype=np.int64))
    assert wide.columns == [*odd_docs.columns, "found_"] and wide.select("kept", "found_.kept").count() == odd_docs.count()
    assert q.rate(no_docs, q.fit(no_docs, no_docs.select("doc_id"))).count() == 0


def test_scores_do_not_depend_on_batches(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    table = q.fit(docs, docs.filter("doc_id % 2 = 0").select("doc_id"))
    assert (table == q.fit(docs.repartition(7), docs.filter("doc_id % 2 = 0").select("doc_id"))).all()
    one = {r["doc_id"]: r["llr"] for r in q.rate(docs, table).collect()}
    assert one == {r["doc_id"]: r["llr"] for r in q.rate(docs.repartition(9), table).collect()}
