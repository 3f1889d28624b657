"""Quality rules: word, symbol, line and repetition counts, then distribution divergence.

A document's character-class histogram and its common-word histogram are compared with those
of each language by Jensen-Shannon distance (square root of the divergence in
bits, 0 to 1).  References are summed over all documents of a language; those of classes need
no word list.  A document fails when its smallest distance over the languages is too large;
short texts have a larger limit, and are guarded by minimum lengths below which a histogram
says too little.

Everything is DataFrame functions.  One pass over the texts writes a small table of counts;
references and verdicts come from that table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from clickstream.llm.native import WS_CHARS, WS_CLASS, let
from clickstream.session import materialize

# Very common words of the reference languages.
COMMON_WORDS = {
    "en": "the of and to in a is that for it was on with as be by at this from or an are not which".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par sur au pas avec ce il sont".split(),
    "es": "de la que el en y los se del las un por con no una su para es al lo como más o".split(),
}
#: Character classes of the histogram, with white space and, as the rest, lower-case letters and controls.
CLASSES = {"upper": "A-Z", "digit": "0-9", "stop": ".,;:!?'\"()\\-", "symbol": "#*$%&|<>@^~_=+/{}\\[\\]\\\\`",
           "other": "^\\x00-\\x7F"}
SYMBOLS = "#*$%&|<>"
WINDOW = 5
_N_CLASSES = 1 + len(CLASSES)


def _count_of(text: Column, chars: str) -> Column:
    """Characters of a class (with few members: what lies between them goes in long runs)."""
    rest = f"[{chars[1:]}]+" if chars[0] == "^" else f"[^{chars}]+"
    return F.char_length(F.regexp_replace(text, rest, ""))


def _spaces(text: Column) -> Column:
    gone = [F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit(""))) for c in WS_CHARS]
    return sum(gone[1:], gone[0])


def words_of(text: Column) -> Column:
    """Words: runs without ASCII white space."""
    core = F.btrim(text, F.lit(WS_CHARS))
    return F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, f"[{WS_CLASS}]+"))


def repeated_words(words: Column) -> Column:
    """Words inside 5-word windows that occur at least twice (every occurrence counts).

    Windows without a repeat cost one hash set.  Otherwise the windows are sorted with their
    places, equal neighbours mark repeats, and the marked windows' union is summed.
    """
    n = F.size(words)

    def marked(s: Column) -> Column:
        same = lambda i, j: F.get(s, i)["w"] == F.get(s, j)["w"]
        places = F.transform(F.sequence(F.lit(0), F.size(s) - 1),
                             lambda k: F.when(F.coalesce(same(k, k - 1), F.lit(False))
                                              | F.coalesce(same(k, k + 1), F.lit(False)), F.get(s, k)["i"]))
        start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        return F.aggregate(
            F.sort_array(F.filter(places, lambda i: i.isNotNull())), start,
            lambda acc, i: F.struct((i + WINDOW).alias("end"),
                                    (acc["n"] + WINDOW - F.greatest(F.lit(0), acc["end"] - i)).alias("n")),
            lambda acc: acc["n"])

    def count(windows: Column) -> Column:
        pairs = F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
        return (F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0))
                .otherwise(let(F.sort_array(pairs), marked)))

    windows = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.concat_ws(" ", F.slice(words, i, WINDOW)))
    return F.when(n <= WINDOW, F.lit(0)).otherwise(let(windows, count)).cast("long")


def _word_features(words: Column, common: list[str]) -> Column:
    """Struct of what depends on the words: their number, repeats, and counts of the common ones."""
    lowered = F.transform(words, lambda w: F.lower(w))
    known = F.filter(lowered, lambda w: w.isin(common))
    counts = let(known, lambda c: F.transform(
        F.array_distinct(c), lambda w: F.struct(w.alias("word"), (F.size(c) - F.size(F.array_remove(c, w))).alias("n"))))
    return F.struct(F.size(words).cast("long").alias("n_words"), repeated_words(words).alias("n_repeat_words"),
                    counts.alias("common"))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """One row of counts per row of ``docs``; a null text counts as empty."""
    common = sorted({w for ws in COMMON_WORDS.values() for w in ws})
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WS_CHARS)) != "")
    n_chars = F.char_length(text)
    base = docs.select(
        F.col(id_col).alias("doc_id"), (F.col(lang_col) if lang_col else F.lit(None).cast("string")).alias("lang"),
        n_chars.cast("long").alias("n_chars"),
        _count_of(text, SYMBOLS).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _spaces(text).cast("long").alias("n_spaces"),
        F.array(*[_count_of(text, c).cast("long") for c in CLASSES.values()]).alias("classes"),
        let(words_of(text), lambda w: _word_features(w, common)).alias("w"))
    return base.select("doc_id", "lang", "n_chars", "n_symbols", "n_dup_lines",
                       F.concat(F.array("n_spaces"), "classes").alias("classes"), "w.n_words", "w.n_repeat_words",
                       "w.common", (F.col("n_chars") - F.col("n_spaces")).alias("word_chars"))


def references(counts: DataFrame, min_share: float = 0.001) -> dict[str, dict]:
    """Class and common-word shares per language, over all documents with that ``lang``.

    ``classes`` of every language with at least ``min_share`` of the characters of all documents
    that have a language (so at most ``1 / min_share`` languages), else None; ``words`` of the
    languages with a word list, else empty.
    """
    mine = counts.where(F.col("lang").isNotNull())
    total = mine.agg(F.sum("n_chars")).first()[0] or 0
    sums = (mine.groupBy("lang").agg(
        F.sum("n_chars").alias("chars"), F.sum("n_words").alias("words"),
        *[F.sum(F.get("classes", F.lit(k))).alias(f"c{k}") for k in range(_N_CLASSES)])
        .where((F.col("words") > 0) & ((F.col("chars") >= total * min_share) | F.col("lang").isin(list(COMMON_WORDS)))).collect())
    words = (mine.where(F.col("lang").isin(list(COMMON_WORDS))).select("lang", F.inline("common"))
             .groupBy("lang", "word").agg(F.sum("n").alias("n")).collect())  # at most languages x common words
    out = {}
    for r in sums:
        shares = [r[f"c{k}"] / r.chars for k in range(_N_CLASSES)]
        own = {w.word: w.n / r.words for w in words if w.lang == r.lang and w.word in COMMON_WORDS[r.lang]}
        out[r.lang] = {"classes": [*shares, max(0.0, 1 - sum(shares))] if r.chars >= total * min_share else None, "words": own}
    return out


def _half(p: Column, q: Column) -> Column:
    """One outcome's part of the divergence in bits."""
    m = (p + q) / 2
    part = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    return (part(p) + part(q)) / 2


def class_distance(ref: dict) -> Column:
    """Distance of a row's character classes from a reference."""
    n = F.greatest(F.col("n_chars"), F.lit(1)).cast("double")
    shares = [F.get("classes", F.lit(k)) / n for k in range(_N_CLASSES)]
    rest = F.greatest(F.lit(0.0), 1 - sum(shares[1:], shares[0]))
    total = F.lit(0.0)
    for p, q in zip([*shares, rest], ref["classes"]):
        total = total + _half(p, F.lit(float(q)))
    return F.sqrt(F.greatest(F.lit(0.0), total))


def word_distance(ref: dict) -> Column:
    """Distance of a row's common words (and all others as one) from a reference.

    A reference word that the row lacks adds half its share, so only the row's own words are walked.
    """
    words = ref["words"]
    if not words:
        return F.lit(1.0)
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    table = F.create_map(*[F.lit(x) for w, q in sorted(words.items()) for x in (w, float(q))])
    start = F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q"))

    def add(acc: Column, x: Column) -> Column:
        p, q = x["n"] / n, F.element_at(table, x["word"])
        return F.when(q.isNull(), acc).otherwise(F.struct(
            (acc["d"] + _half(p, q)).alias("d"), (acc["p"] + p).alias("p"), (acc["q"] + q).alias("q")))

    rest_q = max(0.0, 1 - sum(words.values()))
    return F.aggregate(
        "common", start, add,
        lambda acc: F.sqrt(F.greatest(F.lit(0.0), acc["d"] + _half(F.greatest(F.lit(0.0), 1 - acc["p"]), F.lit(rest_q))
                                      + F.greatest(F.lit(0.0), F.lit(sum(words.values())) - acc["q"]) / 2)))


def judge(counts: DataFrame, refs: dict[str, dict], max_class: float = 0.25, max_word: float = 0.22,
          word_noise: float = 1.0, min_chars: int = 200, min_words: int = 50) -> DataFrame:
    """``counts`` with ``base_failed``, ``class_distance``, ``word_distance``, ``kept``.

    Distances are the smallest over the reference languages, null without any reference; a
    text under ``min_chars`` / ``min_words`` is not judged by the histogram concerned.  The
    common words of a good short text are far from the reference by chance, by an amount that
    falls with the root of the number of words, so the limit of the word distance is
    ``max_word + word_noise / sqrt(n_words)``.  A ``lang`` without common words is judged by
    classes only.
    """
    best = lambda ds: (F.least(*ds) if len(ds) > 1 else ds[0] if ds else F.lit(None).cast("double"))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    worded = [x for x, r in refs.items() if r["words"]]
    out = counts.withColumn("base_failed", base).withColumn(
        "class_distance", best([class_distance(r) for r in refs.values() if r["classes"]]))
    out = out.withColumn("word_distance", best([word_distance(refs[x]) for x in worded]))
    by_word = F.col("lang").isNull() | F.col("lang").isin(worded or [""])
    limit = F.lit(max_word) + F.lit(word_noise) / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))
    far = (((F.col("n_chars") >= min_chars) & (F.col("class_distance") > max_class))
           | (by_word & (F.col("n_words") >= min_words) & (F.col("word_distance") > limit)))
    return out.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(far, F.lit(False)))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang",
            **limits) -> DataFrame:
    """Counts, distances and verdict of every row of ``docs`` (ids may repeat; extra columns are not looked at)."""
    counts = materialize(features(docs, id_col, text_col, lang_col), "quality-counts")
    return judge(counts, references(counts), **limits)
