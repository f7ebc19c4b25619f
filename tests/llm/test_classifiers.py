"""Held-out accuracy of the trained operators, their parts, and odd rows."""

from __future__ import annotations

import collections
import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from actiontally.llm import language_id, quality_pu, toxicity
from actiontally.llm.common import id_mod
from actiontally.llm.queries import QUERIES
from tests.conftest import SF01


def held(key, mod, rest):
    return zlib.crc32(str(key).encode()) % mod == rest


def truth(spark, table, column):
    return {r[0]: r[1] for r in spark.read.parquet(f"{SF01}/{table}.parquet").select("doc_id", column).collect() if r[1] is not None}


@pytest.mark.parametrize(("query", "table", "column", "mod", "rest", "least"), [
    ("op4_language_id", "documents", "lang", 3, 1, 0.98), ("op8_quality_pu", "labels", "quality", 5, 0, 0.95), ("op10_toxicity", "labels", "toxic", 3, 1, 0.95)])
def test_held_out_accuracy(spark, query, table, column, mod, rest, least):
    want, got = truth(spark, table, column), QUERIES[query](spark, SF01).collect()
    assert len(got) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    right = []
    for r in got:
        assert r["held_out"] == held(r["doc_id"], mod, rest) and 0 <= r["score"] <= 1
        if column != "lang":
            assert r["predicted"] == int(r["score"] >= (0.3 if column == "quality" else 0.7))
        if r["held_out"] and r["doc_id"] in want:
            right.append((r["lang_pred"] if column == "lang" else r["predicted"]) == want[r["doc_id"]])
    assert np.mean(right) >= least


def test_language_learns_from_its_own_part_only(spark):
    """Wrong languages of held-out rows change nothing."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang")
    out = id_mod("doc_id", 3) == 1
    wrong = docs.withColumn("lang", F.when(out, F.lit("xx")).otherwise(F.col("lang")))
    a, b = language_id.fit(docs, ~out), language_id.fit(wrong, ~out)
    assert a.languages == b.languages and (a.table == b.table).all() and (a.bias == b.bias).all()


@pytest.mark.parametrize(("module", "column", "mod", "rest"), [(quality_pu, "quality", 5, 0), (toxicity, "toxic", 3, 1)])
def test_held_out_labels_are_never_used(spark, module, column, mod, rest):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    wrong = labels.withColumn(column, F.when(id_mod("doc_id", mod) == rest, 1 - F.col(column)).otherwise(F.col(column)))
    a, b = module.fit(docs, labels), module.fit(docs, wrong)
    assert (a.weights == b.weights).all() and a.bias == b.bias


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 1), (7, 1, 0), (None, 1, 1), (5, None, None), (99, 0, 0)], "doc_id bigint, quality int, toxic int")
    langs = odd_docs.select("doc_id", "text", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b").alias("lang"))
    found = {(r["doc_id"], r["text"]): r for r in language_id.identify(langs, language_id.fit(langs, F.lit(True)), keep=["doc_id", "text"]).collect()}
    assert all((r["lang_pred"] == "und") == (not any(map(str.isalpha, t or ""))) for (_, t), r in found.items())
    none = language_id.fit(langs, F.lit(False))
    assert {r["lang_pred"] for r in language_id.identify(langs, none).collect()} == {"und"}
    for module in (quality_pu, toxicity):
        for lab in (labels, labels.filter("false"), labels.filter("doc_id = 1")):
            rows = module.score(odd_docs.select("doc_id", "text"), module.fit(odd_docs, lab)).collect()
            assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert module.score(no_docs.select("doc_id", "text"), module.fit(no_docs, labels)).count() == 0
        wide = module.score(odd_docs, module.fit(odd_docs, labels))
        assert wide.columns == [*odd_docs.columns, "found_"]
    assert language_id.identify(no_docs.select("doc_id", "text"), none).count() == 0


def test_scores_do_not_depend_on_batches(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    for module, model in ((quality_pu, quality_pu.fit(docs, labels)), (language_id, language_id.fit(docs, F.lit(True)))):
        score = module.score if module is quality_pu else module.identify
        one = {r["doc_id"]: r["score"] for r in score(docs.select("doc_id", "text"), model).collect()}
        assert one == {r["doc_id"]: r["score"] for r in score(docs.select("doc_id", "text").repartition(7), model).collect()}


def test_nonnegative_risk_and_prior_on_known_mixtures():
    rng = np.random.default_rng(1)
    pos, neg = rng.normal(2, 1, (4000, 2)), rng.normal(-2, 1, (4000, 2))
    unl = np.concatenate([pos[:2100], neg[:900]])
    x = np.concatenate([pos[2100:4000], unl]).astype(np.float32)
    is_pos = np.arange(len(x)) < 1900
    prior = quality_pu.class_prior(x[is_pos].sum(axis=1), x[~is_pos].sum(axis=1))
    assert abs(prior - 0.7) < 0.07
    w, b = quality_pu.nonnegative_risk(x, is_pos.astype(float), (~is_pos).astype(float), 0.7)
    assert ((pos @ w + b) > 0).mean() > 0.95 and ((neg @ w + b) < 0).mean() > 0.9


def test_grammar_weighs_patterns_not_words():
    machine = toxicity.grammar()
    lexicon = toxicity.Lexicon({"idiot": 2.0}, {4: {"loss": 1.0}})

    def total(text):
        x = toxicity.clause_features(text.encode(), lexicon, machine)
        return 0.0 if x is None else np.expm1(x[0])

    plain = total("what an idiot")
    assert plain == pytest.approx(2.0) and total("a calm text") == 0.0
    assert total("you idiot") == pytest.approx(2.6) and total("never an idiot") == pytest.approx(0.6)
    assert total("she said what an idiot") > 0 and total("reports said an idiot") == pytest.approx(1.0)
    assert total("never. an idiot") == pytest.approx(2.0)  # a scope ends with its clause
    assert total("we kill time") == 0.0 and total("we will kill you") == pytest.approx(2.0 * 1.0)
    assert total("lossless") == pytest.approx(1.0)


def test_composition_reads_what_the_former_writes():
    run = toxicity.grammar().run
    assert [m for m, _ in run(list("tni"))] == ["t", "n", "iTN"]
    assert [m for m, _ in run(list("ht"))] == ["o", "h"]
    assert run(list("rtni"))[-1][1] == pytest.approx(1.3 * 0.3 * 0.5)


def texts_and_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, {r["doc_id"]: r["text"] for r in docs.collect()}


def plain_language(text, model):
    """Mean of the buckets' rows over every subword, one by one, then the softmax."""
    grams, starts, ends = language_id.subwords([text.encode() if text else None], int(len(model.table)).bit_length() - 1)
    own = [b for h, m in grams for b, inside in zip(h[starts[0]:ends[0]].tolist(), m[starts[0]:ends[0]].tolist()) if inside]
    z = [sum(int(model.table[b, k]) for b in own) / language_id._UNIT / max(1, len(own)) + model.bias[k] for k in range(len(model.languages))]
    e = [math.exp((v - max(z)) / model.temperature) for v in z]
    best = max(range(len(z)), key=z.__getitem__)
    return (model.languages[best], e[best] / sum(e)) if any(map(str.isalpha, text or "")) else ("und", 0.0)


def test_languages_against_a_text_by_text_scorer(spark):
    docs, _, texts = texts_and_labels(spark)
    model = language_id.fit(docs, id_mod("doc_id", 3) != 1)
    for r in language_id.identify(docs, model, keep=["doc_id"]).collect():
        if len(texts[r["doc_id"]] or "") < 20_000:  # the plain scorer is slow
            lang, p = plain_language(texts[r["doc_id"]], model)
            assert r["lang_pred"] == lang and r["score"] == pytest.approx(p, abs=1e-9)


def plain_quality(text, model):
    """Shares of a text's byte n-grams counted in a dict, times their weights; the plain measures as
    they are."""
    t = (text or "").encode()
    n, size = quality_pu.GRAM, 1 << quality_pu.BUCKET_BITS
    counts = collections.Counter(int(quality_pu.gram_buckets(np.frombuffer(t[i : i + n], dtype=np.uint8), quality_pu.BUCKET_BITS)[0]) for i in range(len(t) - n + 1))
    total = max(0, len(t) - n + 1)
    g = sum(float(np.float32(math.sqrt(c / total))) * model.weights[b] for b, c in counts.items()) + model.bias
    g += float((quality_pu.features([t])[0, size:].astype(np.float64) * model.weights[size:]).sum())
    return 1 / (1 + math.exp(-(model.slope * g + model.shift)))


def test_quality_against_a_text_by_text_scorer(spark):
    docs, labels, texts = texts_and_labels(spark)
    model = quality_pu.fit(docs, labels)
    for r in quality_pu.score(docs, model, keep=["doc_id"]).collect():
        if r["doc_id"] % 5 == 0 and len(texts[r["doc_id"]] or "") < 5000:  # the plain scorer is slow
            assert r["score"] == pytest.approx(plain_quality(texts[r["doc_id"]], model), abs=1e-6)


def plain_patterns(own, insults):
    """What each word of a clause is and counts, from the words before it alone: no machine."""
    kinds = ["i" if w in insults else "h" if w in toxicity.THREATS else "t" if w in toxicity.TARGETS else "n" if w in toxicity.NEGATIONS
             else "r" if w in toxicity.REPORTS else "o" for w in own]
    threat = [k == "t" and any(kinds[j] == "h" and "t" not in kinds[j + 1 : i] for j in range(max(0, i - 3), i)) for i, k in enumerate(kinds)]
    read = ["h" if t else "o" if k == "h" else k for k, t in zip(kinds, threat)]
    out = []
    for i, k in enumerate(read):
        marks, weight = "", 1.0
        if kinds[i] == "i":
            run = i > 0 and kinds[i - 1] == "i"
            marks, weight = ("+", toxicity.RUN) if run else ("", toxicity.LONE)
        if k == "t" and i > 0 and kinds[i - 1] == "i":
            marks = "B"
        if k in "ih":
            for trigger, mark, w, reach in (("t", "T", 1.3, 4), ("n", "N", 0.3, 3), ("r", "R", 0.5, 12)):
                if trigger in read[max(0, i - reach) : i]:
                    marks, weight = marks + mark, weight * w
        out.append((k + marks, weight))
    return out


WORDS = st.sampled_from(["idiot", "moron", "kill", "you", "him", "not", "said", "the", "of", "x"])


@settings(max_examples=400, deadline=None)
@given(st.lists(WORDS, max_size=25))
def test_grammar_against_plain_rules(own):
    insults = {"idiot": 2.0, "moron": 1.5}
    symbols = ["i" if w in insults else "h" if w in toxicity.THREATS else "t" if w in toxicity.TARGETS else "n" if w in toxicity.NEGATIONS
               else "r" if w in toxicity.REPORTS else "o" for w in own]
    got, want = toxicity.grammar().run(symbols), plain_patterns(own, insults)
    assert [m for m, _ in got] == [m for m, _ in want]
    assert [w for m, w in got if m[0] in "ih"] == pytest.approx([w for m, w in want if m[0] in "ih"])


def plain_toxicity(text, model):
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    clauses = [re.findall(r"[^\W\d_]+", c) for c in re.split(r"[.!?;:,\n\"“”«»()]+", (text or "").lower())]
    insults = {w: model.lexicon.weight(w) for w in set(words) if model.lexicon.weight(w) > 0}
    sums, count, used = [], collections.Counter(), set()
    for own in clauses:
        total = 0.0
        for w, (mark, weight) in zip(own, plain_patterns(own, insults)):
            count.update(mark[1:])
            if mark[0] in "ih":
                total += weight * (insults[w] if mark[0] == "i" else 2.0)
                count.update(["hit"] + ["threat"] * (mark[0] == "h") + ["plain"] * (mark == "i"))
                used |= {w} if mark[0] == "i" else set()
        sums.append(total)
    if sum(sums) == 0:
        return model.none
    x = [sum(sums), max(sums), *(count[m] for m in toxicity.MARKS), len(used), 100 * count["hit"] / len(words), 10 * sum(sums) / len(words) ** 0.5]
    return 1 / (1 + math.exp(-(sum(math.log1p(v) * w for v, w in zip(x, model.weights)) + model.bias)))


def test_toxicity_against_a_text_by_text_scorer(spark):
    docs, labels, texts = texts_and_labels(spark)
    model = toxicity.fit(docs, labels)
    hard = ["idiot idiot idiot", "You idiot! He said you are not a moron.", "I will kill you", "kill the time", "idiot you", "stupid, stupid"]
    rows = docs.select("doc_id", "text").union(spark.createDataFrame([(-1 - i, t) for i, t in enumerate(hard)], "doc_id bigint, text string"))
    texts |= {-1 - i: t for i, t in enumerate(hard)}
    for r in toxicity.score(rows, model, keep=["doc_id"]).collect():
        assert r["score"] == pytest.approx(plain_toxicity(texts[r["doc_id"]], model), abs=1e-9)


def test_every_entry_with_evidence_is_learned(spark):
    """More entries than any size the lexicon once had, one of one letter and one very long."""
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(3000)] + ["q", "z" * 60]
    rows = [(1, " ".join(words))] * 12 + [(0, "clean prose here")] * 60
    got = toxicity.learn_lexicon(spark.createDataFrame(rows, "y int, text string"), 12, 60)
    assert set(words) <= got.words.keys()


def test_contradicting_labels_and_languages_teach_both(spark):
    docs = spark.createDataFrame([(i, "good words of many kinds " * 5, "a") for i in range(20)] + [(3, "good words of many kinds", "b")], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, v, v) for i in range(20) for v in (0, 1)], "doc_id bigint, quality int, toxic int")
    for module in (quality_pu, toxicity):
        assert all(0 <= r["score"] <= 1 for r in module.score(docs, module.fit(docs, labels)).collect())
    assert language_id.fit(docs, F.lit(True)).languages == ["a", "b"]
