"""Operator 10, toxicity: a weighted finite-state pattern grammar.

Words are read as symbols: insult, threat verb, target, negation, reported speech, other. Five small
weighted transducers, composed into one machine, rewrite a clause's symbols: insults match as a lone
insult, a run of them, or one with its target right behind; a threat is a threat verb followed by a
target; an insult or threat soon after a target counts more, in a negation's scope less, after reported
speech less. What the machine outputs are matched clause patterns, each with a weight of its own; every
feature of a document is taken from its matched clauses, and a logistic model scores those.

The insult lexicon (words, and stems that stand for their forms) and the logistic weights are
learned from a bounded sample of labelled rows; word counts for it are made on Spark.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actiontally.llm.common import class_sample, id_mod, score_texts, small_side

# Closed word classes in the corpus' languages.
TARGETS = frozenset("you your yours u ya he him she her they them their ihr euch dich dir du sie ihm er tu toi vous ton ta elle ils lui tú usted ustedes él ella ellos te vosotros".split())
NEGATIONS = frozenset("not no never nobody nothing neither nor without isn aren wasn don doesn nicht kein keine nie niemals ohne pas jamais aucun sans nunca jamás ningún sin".split())
REPORTS = frozenset("said says say told tells called calls claimed quoted wrote writes allegedly sagte sagt nannte schrieb dit disait appelé écrit dijo dice llamó escribió".split())
THREATS = frozenset("kill kills killing hurt beat destroy smash crush stab shoot burn murder töten schlagen zerstören tuer frapper détruire matar golpear destruir".split())
# Common insults; what else there is, labels teach.
SEEDS = frozenset("idiot idiots stupid moron morons loser losers trash scum pathetic worthless disgusting clown dumb fool imbecile jerk vermin trottel dumm arschloch abschaum crétin abruti connard ordure idiota estúpido imbécil basura".split())
SEED_WEIGHT = 2.0

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = "oihtnr"
#: Bounds of the training sample, by label.
QUOTA = {1: 3000, 0: 12_000}
#: Weights of the insult patterns: alone in its clause's pattern, and each further one of a run.
LONE, RUN = 1.0, 1.2
STEMS = (4, 5)
#: Least likelihood ratio statistic and least log odds of a lexicon entry.
EVIDENCE, LEAST_ODDS = 12.0, 1.5
SCORE_CUT = 0.7
_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE = re.compile(r"[.!?;:,\n\"“”«»()]+")


@dataclass(frozen=True)
class Transducer:
    """States 0 (start) to n - 1; an arc maps a state and a symbol (its first letter) to the next
    state, a mark to append to the symbol, and a weight."""

    arcs: dict[tuple[int, str], tuple[int, str, float]]
    states: int

    def step(self, state: int, symbol: str) -> tuple[int, str, float]:
        nxt, mark, weight = self.arcs[state, symbol[0]]
        return nxt, mark if mark[:1] == "=" else symbol + mark, weight

    def then(self, other: Transducer) -> Composed:
        return Composed([self, other])


@dataclass
class Composed:
    """Each transducer reads what the one before it writes; joint arcs are worked out once each."""

    parts: list[Transducer]
    known: dict = field(default_factory=dict)

    def then(self, other: Transducer) -> Composed:
        return Composed([*self.parts, other])

    def step(self, state: tuple[int, ...], symbol: str) -> tuple[tuple[int, ...], str, float]:
        if (state, symbol) not in self.known:
            nxt, out, weight = [], symbol, 1.0
            for part, s in zip(self.parts, state):
                s, out, w = part.step(s, out)
                out = out.removeprefix("=")
                nxt.append(s)
                weight *= w
            self.known[state, symbol] = (tuple(nxt), out, weight)
        return self.known[state, symbol]

    def run(self, symbols: list[str]) -> list[tuple[str, float]]:
        state, out = (0,) * len(self.parts), []
        for s in symbols:
            state, mark, weight = self.step(state, s)
            out.append((mark, weight))
        return out


def scope(trigger: str, marked: str, mark: str, weight: float, reach: int) -> Transducer:
    """Marks the ``marked`` symbols among the ``reach`` symbols after a trigger."""
    arcs = {}
    for s, c in itertools.product(range(reach + 1), OTHER + INSULT + THREAT + TARGET + NEGATION + REPORT):
        left = reach if c == trigger else max(0, s - 1)
        arcs[s, c] = (left, mark, weight) if s and c in marked else (left, "", 1.0)
    return Transducer(arcs, reach + 1)


def threat_pattern(reach: int = 3) -> Transducer:
    """A threat verb alone becomes an other word; a target within reach of one becomes a threat."""
    arcs = {}
    for s, c in itertools.product(range(reach + 1), OTHER + INSULT + THREAT + TARGET + NEGATION + REPORT):
        if c == THREAT:
            arcs[s, c] = (reach, "=" + OTHER, 1.0)
        elif c == TARGET and s:
            arcs[s, c] = (0, "=" + THREAT, 1.0)
        else:
            arcs[s, c] = (max(0, s - 1), "", 1.0)
    return Transducer(arcs, reach + 1)


def insult_pattern() -> Transducer:
    """An insult word is a lone insult, or, right behind another, one more of a run (+); a target right
    behind an insult is what it is aimed at (B)."""
    arcs = {}
    for s, c in itertools.product(range(2), OTHER + INSULT + THREAT + TARGET + NEGATION + REPORT):
        if c == INSULT:
            arcs[s, c] = (1, "+", RUN) if s else (1, "", LONE)
        else:
            arcs[s, c] = (0, "B" if s and c == TARGET else "", 1.0)
    return Transducer(arcs, 2)


def grammar() -> Composed:
    """insult, then threat, then target (T), then negation (N), then reported speech (R); the last one's
    scope is the rest of a clause of usual length."""
    both = INSULT + THREAT
    return insult_pattern().then(threat_pattern()).then(scope(TARGET, both, "T", 1.3, 4)).then(scope(NEGATION, both, "N", 0.3, 3)).then(scope(REPORT, both, "R", 0.5, 12))


@dataclass
class Lexicon:
    """Insults: weights of words, and of stems by their length."""

    words: dict[str, float]
    stems: dict[int, dict[str, float]]

    def weight(self, w: str) -> float:
        if w in self.words:
            return self.words[w]
        return max((self.stems[n].get(w[:n], 0.0) for n in self.stems if len(w) > n), default=0.0)

    def known(self, words: set[str]) -> dict[str, float]:
        hits = words & self.words.keys()
        for n, stems in self.stems.items():
            if stems:
                hits |= {w for w in words if w[:n] in stems and len(w) > n}
        return {w: self.weight(w) for w in hits}


MARKS = ("plain", "+", "B", "T", "N", "R", "threat")
FEATURES = 5 + len(MARKS)


def clause_features(text: bytes | None, lexicon: Lexicon, machine: Composed) -> np.ndarray | None:
    """Sums over the text's matched clauses; None if no clause matches."""
    t = (text or b"").decode("utf-8", "replace").lower()
    words = _WORD.findall(t)
    distinct = set(words)
    weights = lexicon.known(distinct)
    if not weights and not distinct & THREATS:
        return None
    total, most, hits, found, used = 0.0, 0.0, 0, dict.fromkeys(MARKS, 0), set()
    for clause in _CLAUSE.split(t):
        own = _WORD.findall(clause)
        if not any(w in weights or w in THREATS for w in own):
            continue
        symbols = [INSULT if w in weights else THREAT if w in THREATS else TARGET if w in TARGETS else NEGATION if w in NEGATIONS
                   else REPORT if w in REPORTS else OTHER for w in own]
        score = 0.0
        for w, (mark, weight) in zip(own, machine.run(symbols)):
            if mark[0] in (INSULT, THREAT):
                score += weight * (weights[w] if mark[0] == INSULT else 2.0)
                hits += 1
                found["threat"] += mark[0] == THREAT
                found["plain"] += mark == INSULT
                if mark[0] == INSULT:
                    used.add(w)
            for m in mark[1:]:
                found[m] += 1
        total, most = total + score, max(most, score)
    if total == 0.0:
        return None
    return np.log1p(np.array([total, most, *found.values(), len(used), 100 * hits / max(1, len(words)), 10 * total / max(1, len(words)) ** 0.5]))


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float
    none: float  # score of a text without a matched clause

    def scores(self, texts: list[bytes | None], machine: Composed) -> np.ndarray:
        out = np.full(len(texts), self.none)
        for i, t in enumerate(texts):
            x = clause_features(t, self.lexicon, machine) if t else None
            if x is not None:
                out[i] = 1 / (1 + np.exp(-np.clip(float((x * self.weights).sum()) + self.bias, -30, 30)))
        return out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05, steps: int = 60) -> tuple[np.ndarray, float]:
    z = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    c, pull = np.zeros(z.shape[1]), np.append(np.full(x.shape[1], ridge), 1e-6)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ c, -30, 30)))
        h = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(pull) + 1e-9 * np.eye(len(c))
        step = np.linalg.solve(h, z.T @ (weight * (p - y)) + pull * c)
        c = c - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return c[:-1], float(c[-1])


def learn_lexicon(sample: DataFrame, toxic: int, clean: int) -> Lexicon:
    """Words and stems whose presence speaks for toxicity, from ``y, text`` of the sample: all that pass
    the evidence. Only those reach the driver; each is in three toxic rows of the bounded sample or more."""
    def make() -> Callable:
        def f(texts: list[bytes | None]) -> list[pa.Array]:
            out = []
            for t in texts:
                words = set(_WORD.findall((t or b"").decode("utf-8", "replace").lower()))
                out.append([*("0" + w for w in words), *{f"{n}{w[:n]}" for n in STEMS for w in words if len(w) > n}])
            return [pa.array(out, type=pa.list_(pa.string()))]
        return f

    terms = score_texts(sample, "text", "terms array<string>", make, keep=["y"]).select("y", F.explode("terms").alias("term"))
    a, b = F.col("a"), F.col("n") - F.col("a")
    part = lambda k, e: F.when(k > 0, k * F.log(k / e)).otherwise(0.0)
    both = toxic + clean
    g2 = 2 * (part(a, F.col("n") * toxic / both) + part(b, F.col("n") * clean / both))
    odds = F.log((a + 0.5) / (toxic + 1.0)) - F.log((b + 0.5) / (clean + 1.0))
    found = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("a")).filter("a >= 3").select(
        "term", g2.alias("g2"), odds.alias("odds")).filter((F.col("g2") >= EVIDENCE) & (F.col("odds") >= LEAST_ODDS))
    rows = found.orderBy("term").collect()
    take = lambda n: {r["term"][1:]: r["odds"] for r in rows if r["term"][0] == str(n)}
    return Lexicon({**dict.fromkeys(SEEDS, SEED_WEIGHT), **take(0)}, {n: take(n) for n in STEMS})


def fit(docs: DataFrame, labels: DataFrame, learn_mod: int = 3, held: int = 1, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """A model from the labels of ids whose crc32 modulo ``learn_mod`` isn't ``held``; other labels
    are never looked at. Null ids and labels teach nothing; an id with both labels teaches both. Without toxic rows the lexicon has its
    seeds alone, and every score is that of a text without a match or near it."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & (id_mod(id_col, learn_mod) != held)).select(
        F.col(id_col).alias("key"), F.col(label_col).cast("int").alias("y")).distinct()
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    picked = small_side(class_sample(known, "key", "y", QUOTA).select(F.col("key").alias("chosen"), "y"))
    sample = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text")).join(
        picked, F.col("key") == F.col("chosen")).select("key", "y", "text")
    here = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    lexicon = learn_lexicon(sample, here.get(1, 0), here.get(0, 0)) if here.get(1) else Lexicon(dict.fromkeys(SEEDS, SEED_WEIGHT), {n: {} for n in STEMS})
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)

    def make() -> Callable:
        machine, blank = grammar(), np.zeros(FEATURES)

        def f(texts: list[bytes | None]) -> list[pa.Array]:
            x = [clause_features(t, sent.value, machine) for t in texts]
            return [pa.array([v is not None for v in x]), pa.array([(blank if v is None else v).tolist() for v in x], type=pa.list_(pa.float64()))]
        return f

    got = score_texts(sample, "text", "hit boolean, x array<double>", make, keep=["y"]).toArrow()  # the bounded sample, a few numbers each
    y, hit = got["y"].to_numpy().astype(float), np.array(got["hit"].to_pylist(), dtype=bool)
    if not len(y):
        return Model(lexicon, np.zeros(FEATURES), 0.0, 0.0)
    weight = np.where(y == 1, sizes.get(1, 0) / max(1, y.sum()), sizes.get(0, 0) / max(1, (1 - y).sum()))
    weight = weight / weight.mean()
    none = float((weight * y)[~hit].sum() / max(1e-9, weight[~hit].sum())) if (~hit).any() else 0.0
    x = np.array(got["x"].to_pylist()).reshape(len(y), FEATURES)
    # Texts without a match take part too, as texts with zero in every feature.
    order = np.lexsort(x.T)
    w, b = logistic(x[order], y[order], weight[order])
    return Model(lexicon, w, b, min(none, float(1 / (1 + np.exp(-np.clip(b, -30, 30))))))


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all, if None) with ``score`` (0 to 1). Null and empty texts match no
    clause and score like any text without a match; repeated rows score alike; no rows give none."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable:
        machine = grammar()
        return lambda texts: [pa.array(sent.value.scores(texts, machine))]

    return score_texts(docs, text_col, "score double", make, keep)
