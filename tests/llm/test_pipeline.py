"""The pipeline's stages against brute force on a small corpus, and their contracts."""

from __future__ import annotations

import random
import re

import pytest

import corpus_pipeline as p
from actiontally.llm.common import stored
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_decontaminate import lower
from tests.llm.test_jaccard import brute as components
from tests.llm.test_secret_scan import brute as secrets

BENCH = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short item")]


def corpus():
    rng = random.Random(4)
    vocab = [f"{a}{b}" for a in ("lo", "mi", "ra", "ten", "qua", "sol") for b in ("ra", "nu", "vel", "to", "shi", "per", "gan")]
    clean = [" ".join(rng.choice(vocab) for _ in range(90)) for _ in range(30)]
    rows = [*clean, clean[0], clean[1] + " extra", clean[2].capitalize(), None, "", "too short", "word " * 100]
    rows.append(clean[3][:300] + " " + BENCH[0][1] + " " + clean[4])
    rows.append(clean[5] + "\npassword = abcdefghijklmnop1234 \n" + clean[6])
    rows.append(" ".join(f"{w}$$$###" for w in clean[7].split()))
    return [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(rows)]


@pytest.fixture()
def sf(tables):
    return tables(corpus(), [(i, 1, 0) for i in range(30)], BENCH)


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_match_brute_force(spark, sf):
    docs = p.table(spark, sf, "documents")
    assert [n for n, _ in p.STAGES] == ["quality_rules", "ngram_jaccard", "decontamination", "secret_scan", "packing"]
    steps = []
    for _, stage in p.STAGES:
        out = stored(stage(spark, docs, sf), "step")
        steps.append((docs, out))
        docs = out
    for before, after in steps[:-1]:
        assert after.columns == before.columns

    before, after = map(texts, steps[0])
    assert set(before) - set(after) == {33, 34, 35, 36, 39} and all(after[k] == before[k] for k in after)

    before, after = map(texts, steps[1])
    kept = {i for i, n, c in components([*before.items()], 5, 80) if not n or i == c}
    assert set(after) == kept and {30, 31, 32}.isdisjoint(after)

    before, after = map(texts, steps[2])
    for k, t in before.items():
        n, hit, _ = contaminated(t, BENCH)
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(after[k]))
        assert len(words) == n - hit and (hit or after[k] == t)
    assert "kappa" not in after[37]

    before, after = map(texts, steps[3])
    for k, t in before.items():
        assert (after[k] == t) == (not secrets(t)) and not secrets(after[k])
    assert "[assign]" in after[38]
    assert all(r["n_chars"] == len(r["text"]) for r in steps[3][1].collect())

    pieces = steps[4][1].collect()
    assert {r["doc_id"] for r in pieces} == set(after) and len({(r["sequence_id"], r["offset"]) for r in pieces}) == len(pieces)
    assert sorted(map(str, p.run(spark, sf).drop("sequence_id", "offset", "start", "length", "ids_crc32", "first", "last").distinct().collect())) == sorted(
        map(str, steps[4][1].drop("sequence_id", "offset", "start", "length", "ids_crc32", "first", "last").distinct().collect()))


def test_odd_and_empty_tables_pass(spark, sf, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in p.STAGES:
            out = stored(stage(spark, docs, sf), name)
            if name != "packing":
                assert out.columns == docs.columns
            if name == "ngram_jaccard" and docs is odd_docs:
                # The repeated row stays once, texts without words stay, and an id with two texts keeps both.
                assert sorted(str(r["doc_id"]) for r in out.select("doc_id").collect()) == ["1", "2", "3", "4", "5", "6", "6", "7", "None", "None"]


def test_texts_go_to_python_in_bounded_batches(spark, monkeypatch):
    """A step's tasks hold little of the texts outside the heap, whatever the number of rows."""
    from actiontally.llm import common, decontaminate, jaccard, packing, quality_rules

    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.range(0, 4000, 1, 1).selectExpr("id as doc_id", "concat(id, repeat(' word', 400)) as text")
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string")
    plain = common.slices

    def checked(batches, column):
        def seen():
            for b in batches:
                assert b.nbytes < 3 << 20, b.nbytes
                yield b
        return plain(seen(), column)

    for m in (common, decontaminate, jaccard, packing, quality_rules):
        monkeypatch.setattr(m, "slices", checked)
    run = lambda df: df.write.format("noop").mode("overwrite").save()
    vocabulary = p.public_tokenizers.path("word_bpe_49k.json")
    ratios = quality_rules.fit(docs, docs.select("doc_id"))
    for step in (lambda: quality_rules.rate(docs, ratios), lambda: decontaminate.contamination(docs, bench, clean=True),
                 lambda: packing.pack(docs, vocabulary), lambda: jaccard.near_duplicates(docs)):
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        run(step())
