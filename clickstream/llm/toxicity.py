"""Toxicity by a weighted finite-state pattern grammar.

Texts are cut into clauses and clauses into words.  Every word has one of six kinds: insult,
threat, target, negation, reported speech, or other.  Four small transducers run side by
side, each reading kinds and keeping its own state:

* negation   - a negation word opens a scope of ``NEGATION_SCOPE`` words;
* reported   - a speech verb puts the rest of the clause into reported speech;
* target     - a word for a person has been read in this clause;
* hostility  - insults and threats emit their weight.

Their product is one transducer: a table from (state, kind) to (next state, factor).  An
insult or a threat emits its weight times the factor of the state it is met in (more with a
target, less when negated or reported), and a clause's score is what it emits.  A document's
score is a logistic curve over its clauses' scores.

Targets, negations, speech verbs and threats are closed word lists.  Insults are open
vocabulary and learned: whole words and word beginnings that labelled toxic documents hold
far more often than clean ones, weighted by the log odds.  Threats weigh on the same scale:
their log odds where labelled documents hold aimed threats, else the median insult's, and
then enough for one plain aimed threat to decide a document.  The fit reads a bounded sample of
labelled rows (``max_fit_rows``, by a hash of the id); scoring reads every whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clickstream.llm.common import bounded_fraction, fresh

# Closed word classes of the four languages.
TARGETS = """you your yours he him his she her they them their people folks du dich dir dein deine ihr euch euer sie
ihn ihm leute tu toi te vous votre ton ta il elle ils elles eux gens usted ustedes vosotros ellos ellas gente""".split()
NEGATIONS = "not no never none neither nor cannot nicht kein keine keinen nie niemals ne pas jamais aucun sin nunca jamás".split()
REPORTS = """said says say wrote writes claimed claims called calls quoted quote reported sagte sagt schrieb nannte zitierte
dit disait écrit appelait cité dijo dice escribió llamó citó""".split()
THREATS = """kill killing murder destroy hurt beat attack strangle stab shoot töten umbringen schlagen vernichten tuer frapper
détruire matar golpear destruir""".split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
NEGATION_SCOPE = 2
#: Lengths in letters of the word beginnings that can be insults.
STEMS = (4, 5, 6, 7, 8)
THREAT_WEIGHT = 1.0
#: How far above the curve's midpoint one plain aimed threat lies at least.
THREAT_MARGIN = 1.05
#: Curve without labels.
PRIOR_SLOPE, PRIOR_OFFSET = 1.0, -4.0
#: Factors of the product transducer.
WITH_TARGET, NEGATED, REPORTED = 1.5, 0.5, 0.6

_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE = re.compile(r"[.!?;:\n]")


# ------------------------------------------------------------------ transducers

class Transducer(NamedTuple):
    """``step[state][kind]`` is the next state, ``factor[state]`` scales what is emitted in a state."""

    step: list[list[int]]
    factor: list[float]


def _negation() -> Transducer:
    step = [[max(0, s - 1)] * 6 for s in range(NEGATION_SCOPE + 1)]
    for row in step:
        row[NEGATION] = NEGATION_SCOPE
    return Transducer(step, [1.0] + [NEGATED] * NEGATION_SCOPE)


def _latch(kind: int, factor: float) -> Transducer:
    step = [[0] * 6, [1] * 6]
    step[0][kind] = 1
    return Transducer(step, [1.0, factor])


def compose(a: Transducer, b: Transducer) -> Transducer:
    """Both transducers side by side: states are pairs, factors multiply."""
    n = len(b.factor)
    step = [[a.step[s][k] * n + b.step[t][k] for k in range(6)] for s in range(len(a.factor)) for t in range(n)]
    return Transducer(step, [x * y for x in a.factor for y in b.factor])


GRAMMAR = compose(compose(_negation(), _latch(REPORT, REPORTED)), _latch(TARGET, WITH_TARGET))


class Lexicon:
    """Kind and weight of a word; insults by whole word first, then by the longest known beginning."""

    def __init__(self, insults: dict[str, float], threat: float = THREAT_WEIGHT):
        self.threat = threat
        self.words = {w[1:]: v for w, v in insults.items() if w[0] == "="}
        self.stems = {w[1:]: v for w, v in insults.items() if w[0] == "^"}
        self.closed = {w: k for k, ws in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS))
                       for w in ws}
        self.memory: dict[str, tuple[int, float]] = {}

    def kind(self, word: str) -> tuple[int, float]:
        got = self.memory.get(word)
        if got is None:
            if len(self.memory) > 200_000:  # a working set, not the vocabulary
                self.memory.clear()
            got = self.memory[word] = self._kind(word)
        return got

    def _kind(self, word: str) -> tuple[int, float]:
        if word in self.words:
            return INSULT, self.words[word]
        if word in self.closed:
            k = self.closed[word]
            return k, self.threat if k == THREAT else 0.0
        for n in sorted(STEMS, reverse=True):
            if len(word) >= n and word[:n] in self.stems:
                return INSULT, self.stems[word[:n]]
        return OTHER, 0.0


def clause_scores(text: str | None, lexicon: Lexicon) -> list[float]:
    """What each clause with an insult or threat emits.

    A threat counts only once a target has been read in its clause (before or after it); a
    bare verb is no threat.
    """
    out = []
    for clause in _CLAUSE.split((text or "").lower()):
        kinds = [lexicon.kind(w) for w in _WORD.findall(clause)]
        if not any(v for _, v in kinds):
            continue
        aimed = any(k == TARGET for k, _ in kinds)
        state, total = 0, 0.0
        for k, v in kinds:
            if v and (k == INSULT or aimed):
                total += v * GRAMMAR.factor[state]
            state = GRAMMAR.step[state][k]
        if total:
            out.append(total)
    return out


def document_signal(text: str | None, lexicon: Lexicon) -> float:
    """The strongest clause plus the logarithm of the rest: one attack counts, repetition adds slowly."""
    scores = clause_scores(text, lexicon)
    return max(scores) + math.log1p(sum(scores) - max(scores)) if scores else 0.0


class ToxicityModel(NamedTuple):
    insults: dict[str, float]
    slope: float
    offset: float
    threat: float = THREAT_WEIGHT


def has_aimed_threat(text: str | None) -> bool:
    """Whether some clause holds a threat and a target, neither negated nor reported."""
    return max(clause_scores(text, _PLAIN_THREATS), default=0.0) >= 1


_PLAIN_THREATS = Lexicon({}, 1.0)


# ------------------------------------------------------------------ fit

def _threat_weight(weight: float, odds: float | None, min_odds: float, slope: float, offset: float) -> float:
    """``weight`` raised so that one plain aimed threat decides, unless labels deny it (``odds`` below ``min_odds``)."""
    if slope <= 0 or (odds is not None and odds < min_odds):
        return weight
    return max(weight, THREAT_MARGIN * -offset / slope)


def _terms(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    return {"=" + w for w in words} | {"^" + w[:n] for w in words for n in STEMS if len(w) >= n}


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a regularised one-variable logistic fit (Newton steps)."""
    w = np.zeros(2)
    a = np.stack([x, np.ones_like(x)], axis=1)
    ridge = np.array([1e-2, 1e-4])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + ridge * w
        hess = (a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge + 1e-9)
        step = np.clip(np.linalg.solve(hess, grad), -2, 2)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic", max_fit_rows: int = 20_000, min_docs: int = 4,
        min_odds: float = 3.0, max_terms: int = 20_000) -> ToxicityModel:
    """Learn insults and the curve from labelled rows.

    ``usable``: condition on ``doc_id`` of the rows that may be learned from.  At most about
    ``max_fit_rows`` labelled rows are read (by a hash of the id), at most ``max_terms``
    terms are kept.  A document with several labels counts as toxic if any says so; null
    labels are left out.  Without toxic labels the model knows no insults.
    """
    mine = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y"))
            .where("y is not null and doc_id is not null"))
    if usable is not None:
        mine = mine.where(usable)
    mine = mine.groupBy("doc_id").agg(F.max("y").alias("y"))
    chosen = bounded_fraction(mine, F.col("doc_id"), max_fit_rows)
    mine = mine.where(chosen)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    if usable is not None:
        texts = texts.where(usable)
    sample = texts.where(chosen).join(mine, "doc_id")  # the texts are cut by the same hash before the join
    n1, n0 = (r := sample.agg(F.sum("y"), F.sum(1 - F.col("y"))).first())[0] or 0, r[1] or 0
    if not n1:
        return ToxicityModel({}, PRIOR_SLOPE, PRIOR_OFFSET,
                             _threat_weight(THREAT_WEIGHT, None, min_odds, PRIOR_SLOPE, PRIOR_OFFSET))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = (Counter(), Counter())
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[1 if y else 0].update(_terms(t or ""))
            terms = list(seen[0].keys() | seen[1].keys())
            yield pa.record_batch({"term": pa.array(terms, pa.string()),
                                   "clean": pa.array([seen[0][x] for x in terms], pa.int64()),
                                   "toxic": pa.array([seen[1][x] for x in terms], pa.int64())})

    odds = (F.log((F.col("toxic") + 0.5) / F.lit(n1 + 1.0)) - F.log((F.col("clean") + 0.5) / F.lit(n0 + 1.0)))
    best = (sample.select("text", "y").mapInArrow(count, "term string, clean long, toxic long")
            .groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
            .where(F.col("toxic") >= min_docs).withColumn("odds", odds).where(F.col("odds") >= min_odds)
            .orderBy(F.desc("odds"), "term").limit(max_terms).collect())
    insults = {r.term: float(r.odds) for r in best}

    @F.arrow_udf("boolean")
    def aimed(arr: pa.Array) -> pa.Array:
        return pa.array([has_aimed_threat(t) for t in arr.to_pylist()], pa.bool_())

    held = dict(sample.where(aimed("text")).groupBy((F.col("y") > 0).alias("toxic")).count().collect())
    t1, t0 = held.get(True, 0), held.get(False, 0)
    seen = None if t1 + t0 < min_docs else math.log((t1 + 0.5) / (n1 + 1)) - math.log((t0 + 0.5) / (n0 + 1))
    threat = max(0.0, seen) if seen is not None else float(np.median(list(insults.values()))) if insults else THREAT_WEIGHT
    lexicon = Lexicon(insults, threat)

    @F.arrow_udf("double")
    def signal(arr: pa.Array) -> pa.Array:
        return pa.array([document_signal(t, lexicon) for t in arr.to_pylist()], pa.float64())

    points = sample.select("y", signal("text").alias("x")).toPandas()  # two numbers a row, max_fit_rows rows
    slope, offset = _logistic(points["x"].to_numpy(float), (points["y"].to_numpy() > 0).astype(float))
    if not points["x"].any():  # nothing to learn a slope from
        slope = PRIOR_SLOPE
    return ToxicityModel(insults, slope, offset, _threat_weight(threat, seen, min_odds, slope, offset))


# ------------------------------------------------------------------ scoring

def toxicity_score(text: Column, model: ToxicityModel) -> Column:
    """Probability (0 to 1) that a text is toxic; null and empty texts get that of a text without hostility."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lexicon = Lexicon(model.insults, model.threat)
        for arr in batches:
            x = np.array([document_signal(t, lexicon) for t in arr.to_pylist()], float)
            yield pa.array(1 / (1 + np.exp(-np.clip(model.slope * x + model.offset, -700, 700))))

    return score(text)


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``; columns unchanged."""
    score = fresh(docs, "score")
    return docs.withColumn(score, toxicity_score(F.col(text_col), model)).where(F.col(score) < threshold).drop(score)
