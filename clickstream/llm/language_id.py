"""Language identification by word-first backoff.

Every word of a text votes with its log probability in each language.  A word that the model
knows uses the words' relative frequencies; any other word falls back to character n-grams
of the word between word marks, first the longest, then shorter ones, until some n-gram of
that length is known: the known n-grams of that length give the mean log probability.

All languages are smoothed over one vocabulary per order, that of all of them together, so a
language with few words does not give an unseen word more than the languages that have it.

Fitting counts words and n-grams per language with Spark over a bounded sample of labelled
texts (``max_fit_rows``, by a hash of the id; whole texts), keeps at most ``max_words`` words
and ``max_grams`` n-grams, and sends these to the workers.  Scoring reads every whole text.
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

from clickstream.llm.common import bounded_fraction, by_size, flat
from clickstream.session import materialize

_WORD = re.compile(r"[^\W\d_]+")
#: Lengths of the n-grams, longest first; words are put between these marks.
ORDERS = (5, 4, 3, 2, 1)
MARK = "\x02"
#: What a backed-off word costs against a known one, per step (in nats).
BACKOFF = 0.5
#: Added to every count.
SMOOTH = 0.2
#: Longer runs of letters are not stored as words; they vote by their n-grams, over the whole run.
LONGEST = 64
#: Words whose evidence is counted in full; beyond that the score's evidence is their share of this many.
FULL_WORDS = 20
UNDETERMINED = "und"
MEMORY_WORDS = 400_000
MEMORY_LETTERS = 1 << 23
SCAN_CHARS = 1 << 21


class LanguageModel(NamedTuple):
    languages: tuple[str, ...]
    words: dict[str, list[float]]
    grams: dict[str, list[float]]
    unseen: list[float]
    #: Per order (0 for words): what brings each language's own smoothing to the vocabulary of all languages.
    shared: dict[int, list[float]] = {}


def grams_of(word: str, n: int) -> Iterator[str]:
    padded = MARK + word + MARK
    return (padded[i:i + n] for i in range(len(padded) - n + 1))


# ------------------------------------------------------------------ fit

def fit(docs: DataFrame, usable: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", max_fit_rows: int = 20_000, max_words: int = 100_000, max_grams: int = 200_000,
        min_count: int = 3, max_languages: int = 200) -> LanguageModel:
    """Learn from rows with a text and a language.

    ``usable``: condition (on the columns of ``docs``) of the rows that may be learned from.
    Words and n-grams seen fewer than ``min_count`` times are left out; if there are still
    more than the bound, the most frequent stay (ties by spelling).  At most
    ``max_languages`` languages, the most frequent, are learned.  Without any usable row the
    model has no language and every text is undetermined.
    """
    mine = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    if usable is not None:
        mine = mine.where(usable)
    mine = mine.where(bounded_fraction(mine, F.col(id_col), max_fit_rows)).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: dict[str, Counter] = {}
            for lang, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words.setdefault(lang, Counter()).update(_WORD.findall(t.lower()))
            rows = []
            for lang, seen in words.items():
                grams: Counter = Counter()
                for w, c in seen.items():
                    for n in ORDERS:
                        for g in grams_of(w, n):
                            grams[g] += c
                rows += [(lang, 0, w, c) for w, c in seen.items() if len(w) <= LONGEST]
                rows += [(lang, len(g), g, c) for g, c in grams.items()]
            cols = list(zip(*rows)) or [[], [], [], []]
            yield pa.record_batch({"lang": pa.array(cols[0], pa.string()), "kind": pa.array(cols[1], pa.int32()),
                                   "term": pa.array(cols[2], pa.string()), "n": pa.array(cols[3], pa.int64())})

    counts = (mine.mapInArrow(count, "lang string, kind int, term string, n long")
              .groupBy("lang", "kind", "term").agg(F.sum("n").alias("n")))
    counts = materialize(counts, "language-counts")
    totals = counts.groupBy("lang", "kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("terms"))
    # the languages with the most letters; all orders of each
    most = totals.where("kind = 1").orderBy(F.desc("n"), "lang").limit(max_languages).collect()
    languages = tuple(sorted(r.lang for r in most))
    rows = totals.where(F.col("lang").isin(list(languages) or [""])).collect()  # a row per language and order
    size = {(r.lang, r.kind): (r.n, r.terms) for r in rows}

    known = F.col("lang").isin(list(languages) or [""])
    vocabulary = {r.kind: r.terms for r in counts.where(known).groupBy("kind").agg(F.countDistinct("term").alias("terms")).collect()}
    shared = {}
    for kind, terms in vocabulary.items():
        own = [(n, SMOOTH * t) if n else (0, 1) for n, t in (size.get((x, kind), (0, 0)) for x in languages)]
        shared[kind] = [math.log((n + mass) / (n + SMOOTH * terms)) for n, mass in own]

    def table(kinds: Column, most: int) -> dict[str, list[float]]:
        best = (counts.where(kinds & known).groupBy("kind", "term")
                .agg(F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("by"))
                .where(F.col("total") >= min_count).orderBy(F.desc("total"), "term").limit(most).collect())
        out = {}
        for r in best:
            seen = {x.lang: x.n for x in r.by}
            out[r.term] = [math.log((seen.get(x, 0) + SMOOTH) / (size[x, r.kind][0] + SMOOTH * size[x, r.kind][1]))
                           if (x, r.kind) in size else math.log(SMOOTH) for x in languages]
        return out

    return LanguageModel(languages, table(F.col("kind") == 0, max_words), table(F.col("kind") > 0, max_grams),
                         [0.0] * len(languages), shared)


# ------------------------------------------------------------------ scoring

def word_vector(word: str, model: LanguageModel) -> list[float]:
    """Log probability of a word in each language."""
    none = [0.0] * len(model.languages)
    got = model.words.get(word)
    if got is not None:
        return [x + y for x, y in zip(got, model.shared.get(0, none))]
    for step, n in enumerate(ORDERS, 1):
        shared = model.shared.get(n, none)
        if len(word) > LONGEST:  # each known n-gram once, with its number
            seen = Counter(g for g in grams_of(word, n) if g in model.grams)
            if seen:
                total = np.array(list(seen.values())) @ np.array([model.grams[g] for g in seen]) / seen.total()
                return (total + np.array(shared) - BACKOFF * step).tolist()
            continue
        known = [g for g in map(model.grams.get, grams_of(word, n)) if g is not None]
        if known:
            return [sum(x) / len(known) + y - BACKOFF * step for x, y in zip(zip(*known), shared)]
    return model.unseen


class Scorer:
    """Scores texts with one model, remembering the vectors of the words it has met."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.letters = 0
        self.vectors = np.zeros((1 << 14, max(1, len(self.model.languages))))

    def totals(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(summed log probabilities of each text, number of words of each text; 0 without a letter or a language)."""
        if not self.model.languages:
            return np.zeros((len(texts), 1)), np.zeros(len(texts), np.int64)
        cut = [_WORD.findall(t.lower()) if t else [] for t in texts]
        cut = [ws if any(map(str.isalpha, ws)) or any(c.isalpha() for w in ws for c in w) else [] for ws in cut]
        every = set().union(*cut) if cut else set()
        new = every - self.number.keys()
        if len(self.number) + len(new) > MEMORY_WORDS or self.letters > MEMORY_LETTERS:
            self._forget()
            new = every
        if new:
            self.letters += sum(map(len, new))
            n = len(self.number)
            while n + len(new) > len(self.vectors):
                self.vectors = np.concatenate((self.vectors, np.zeros_like(self.vectors)))
            self.vectors[n:n + len(new)] = [word_vector(w, self.model) for w in new]
            self.number.update(zip(new, range(n, n + len(new))))
        counts = np.array([len(ws) for ws in cut], np.int64)
        at = np.fromiter((k for ws in cut for k in map(self.number.__getitem__, ws)), np.int64, int(counts.sum()))
        stops = np.cumsum(counts)
        run = np.concatenate((np.zeros((1, self.vectors.shape[1])), np.cumsum(self.vectors[at], axis=0)))
        return run[stops] - run[stops - counts], counts


def predict(text: Column, model: LanguageModel) -> Column:
    """``struct(lang_pred, score)`` of a text column.

    ``score`` (0 to 1) is the share of the best language's likelihood, the evidence of long
    texts being held to ``FULL_WORDS`` words.  Ties go to the language first by name.  A null
    text, one without a letter, or a model without languages: ``und`` with score 0.
    """

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def guess(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model)
        names = np.array([*model.languages, UNDETERMINED], object)
        for arr in batches:
            texts = arr.to_pylist()
            langs, scores = [], []
            for a, b in by_size(texts, SCAN_CHARS):
                total, n = scorer.totals(texts[a:b])
                total = total * (np.minimum(n, FULL_WORDS) / np.maximum(n, 1))[:, None]
                share = np.exp(total - total.max(axis=1, keepdims=True))
                share /= share.sum(axis=1, keepdims=True)
                best = share.argmax(axis=1)
                langs.extend(names[np.where(n > 0, best, -1)].tolist())
                scores.append(np.where(n > 0, share[np.arange(len(n)), best], 0.0))
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(flat(scores, float))],
                                             names=["lang_pred", "score"])

    return guess(text)
