"""Secret scan: base patterns, and tokens that pass a randomness test battery.

Base kinds are regular expressions (``assign``, ``access``, ``hex``).  The method adds kind
``random``: maximal runs of 20 and more key characters, outside base spans, that look drawn
at random.  For the smallest encoding whose alphabet has all of a token's characters (hex,
base32, base62, base64; each in its usual order):

* chi-squared uniformity of the characters over the alphabet;
* runs above and below the middle of the alphabet (Wald-Wolfowitz);
* lag-one serial correlation of the characters' places in the alphabet.

A token is plausible when none of the three rejects randomness at ``alpha`` / 3.  Against
text, each test gives plausible tokens a p-value of its own:

* uniformity: the likelihood-ratio (G) form of chi-squared to uniform letters less that to
  text's letters;
* runs: changes between upper case, lower case, digits and symbols;
* serial: association of each letter with the one before, on the corpus's own letter pairs.

Each has the distribution it has in text of the token's encoding, length and number of letters
(mean, deviation, skew), for several ways of writing text: one case or capitalised words, with few or many
digits, with or without separators.  These are measured on strings drawn from a chain of the
corpus's letter pairs, which all documents count.  The three p-values are combined by their
normal scores, weighted by how far random tokens lie from text and by the measured
correlations; the largest p over the ways of writing counts.  Benjamini-Hochberg at
``fdr`` within length bands, over the tokens of all documents, keeps the share of text among
the reported tokens down however many tokens are tested; short bands do not spend the
allowance of long ones.

DataFrame functions only; the driver draws a fixed number of strings from the at most 37 x 36
pair counts.  Texts are read twice (spans, words); what is shuffled are matches and distinct words.
"""

from __future__ import annotations

import json
import math
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from clickstream.llm.native import far_tail, let, normal_tail
from clickstream.session import materialize

KINDS = ("assign", "access", "hex", "random")
# The base patterns and the alphabets.
PATTERNS = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+",
    "random": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}",
}
ASSIGN_VALUE = 6
HEX, BASE32 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
BASE64 = BASE62 + "+/"
LETTERS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Letters of 1000 in ordinary text (mean of the common European languages), the prior of the corpus's own counts.
TEXT_LETTERS = dict(zip(LETTERS, (87, 13, 32, 46, 145, 12, 14, 30, 74, 4, 6, 46, 28, 78, 59, 24, 5, 66, 71, 69, 42, 12, 9, 2, 9, 6)))
#: Chance, at least, that text goes from a letter to a digit or back: names with numbers are common among tokens.
TEXT_TURN = 0.15
#: Lower ends of the length bands within which discoveries are controlled.
LENGTH_BANDS = (20, 24, 32, 48, 96)
_LOG_BINS = 60
#: Encodings, and the mean length of words, at most, in text without separators (abbreviations are short).
ENCODINGS = (HEX, BASE32, BASE62, BASE64)
WORD_LENGTH = 5.0
#: The tests whose p-values are combined, and the strings drawn for each way of writing text.
TESTS = ("uniform", "runs", "serial")
DRAWN = 4000


def _matches(text: Column, kind: str) -> Column:
    """``array<struct<kind, k, gap, m>>``: each match with the code points between it and the one before.

    ``split`` and ``regexp_extract_all`` run the same search, so pieces and matches alternate.
    """
    pattern = F.lit(PATTERNS[kind])

    def pair(found: Column) -> Column:
        return F.when(F.size(found) == 0, F.array().cast(_MATCH)).otherwise(
            F.transform(F.arrays_zip(F.slice(F.transform(F.split(text, PATTERNS[kind], -1), lambda x: F.char_length(x)),
                                             1, F.size(found)).alias("g"), found.alias("m")),
                        lambda x, k: F.struct(F.lit(KINDS.index(kind)).alias("kind"), k.alias("k"),
                                              x["g"].alias("gap"), x["m"].alias("m"))))

    return let(F.regexp_extract_all(text, pattern, F.lit(0)), pair)


_MATCH = "array<struct<kind:int,k:int,gap:int,m:string>>"


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, doc_id, kind, start, end, m)``: candidates of all kinds, and a row with null ``kind`` for every input row.

    Positions are code points, ends exclusive.  Each input row has its own ``row`` number, so
    ids may repeat or be null.  The running sum of gaps and lengths is per (row, kind).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    itself = F.array(F.lit(None)).cast(_MATCH)
    found = F.concat(itself, *[_matches(text, k) for k in KINDS])
    rows = (docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), found.alias("f"))
            .select("row", "doc_id", F.explode("f").alias("f"))
            .select("row", "doc_id", "f.kind", "f.k", "f.gap", "f.m"))
    order = Window.partitionBy("row", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    size = F.char_length("m")
    end = F.sum(F.col("gap") + size).over(order)
    return rows.repartition("row").select(
        "row", "doc_id", "kind", (end - size).alias("start"), end.alias("end"), "m").where(_passes())


def _passes() -> Column:
    value = F.regexp_extract("m", PATTERNS["assign"], 2)
    return F.col("kind").isNull() | (F.col("kind") != 0) | (F.char_length(value) >= ASSIGN_VALUE)


# ------------------------------------------------------------------ battery

def battery(token: Column) -> Column:
    """Struct of the three z-scores (``chi``, ``runs``, ``serial``) and ``n``."""
    return let(_core(token), lambda x: _scores(x["t"], x["a"]))


def _core(token: Column) -> Column:
    """Struct of a token's characters without padding (``t``) and its smallest alphabet (``a``)."""
    core = F.regexp_replace(F.translate(F.rtrim(token, F.lit("=")), "-_", "+/"), "=", "")
    alphabet = (F.when(core.rlike("^[0-9a-f]+$"), F.lit(HEX)).when(core.rlike("^[0-9A-F]+$"), F.lit(HEX.upper()))
                .when(core.rlike("^[A-Z2-7]+$"), F.lit(BASE32)).when(core.rlike("^[A-Za-z0-9]+$"), F.lit(BASE62))
                .otherwise(F.lit(BASE64)))
    return F.struct(core.alias("t"), alphabet.alias("a"))


def _scores(token: Column, alphabet: Column) -> Column:
    n = F.char_length(token).cast("double")
    k = F.char_length(alphabet).cast("double")
    chars = F.split(token, "")
    squares = F.aggregate(
        F.split(alphabet, ""), F.lit(0.0),
        lambda acc, c: acc + F.pow((F.char_length(token) - F.char_length(F.replace(token, c, F.lit("")))).cast("double"), F.lit(2.0)))
    places = F.transform(chars, lambda c: F.instr(alphabet, c).cast("double") - 0.5)

    def rest(v: Column) -> Column:
        stat = v["sq"] * k / n - n
        chi = (stat - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
        return let(v["p"], lambda p: F.struct(
            chi.alias("chi"), _runs(p, n, k).alias("runs"), _serial(p, n, k).alias("serial"),
            F.char_length(token).alias("n")))

    return let(F.struct(squares.alias("sq"), places.alias("p")), rest)


def _runs(places: Column, n: Column, k: Column) -> Column:
    """z of the number of runs on one side of the alphabet's middle; one side alone counts as one run."""
    side = F.transform(places, lambda p: F.when(p > k / 2, F.lit(1.0)).otherwise(F.lit(0.0)))

    def score(s: Column) -> Column:
        high = F.aggregate(s, F.lit(0.0), lambda a, x: a + x)
        turns = F.aggregate(F.zip_with(s, F.slice(s, F.lit(2), F.size(s)), lambda a, b: F.coalesce(F.abs(a - b), F.lit(0.0))),
                            F.lit(0.0), lambda a, x: a + x)
        # under randomness each side has half, so the number of turns is binomial (n - 1, 1/2)
        return F.greatest(F.abs(turns - (n - 1) / 2) / F.sqrt((n - 1) / 4), F.abs(high - n / 2) / F.sqrt(n / 4) - 1)

    return let(side, score)


def _serial(places: Column, n: Column, k: Column) -> Column:
    """z of the lag-one correlation of places, with the uniform alphabet's mean and variance."""
    mean, var = k / 2, (k * k - 1) / 12
    dev = F.transform(places, lambda p: p - mean)

    def score(d: Column) -> Column:
        total = F.aggregate(F.zip_with(d, F.slice(d, F.lit(2), F.size(d)), lambda a, b: F.coalesce(a * b, F.lit(0.0))),
                            F.lit(0.0), lambda a, x: a + x)
        return total / (var * F.sqrt(n - 1))

    return let(dev, score)


# ------------------------------------------------------------------ evidence against text

def text_pairs(docs: DataFrame, text_col: str = "text") -> dict[str, int]:
    """Pairs of characters (a blank before the first) in the words below 20 characters of all documents.

    Longer runs are what is tested, so no token is its own null.
    """
    found = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit("[a-z0-9]+"), F.lit(0))
    words = (docs.select(F.explode(found).alias("w")).where(F.char_length("w") < LENGTH_BANDS[0])
             .groupBy("w").agg(F.count(F.lit(1)).alias("n")))
    marked = F.concat(F.lit(" "), "w")
    pairs = F.transform(F.sequence(F.lit(1), F.char_length("w")), lambda i: F.substr(marked, i, F.lit(2)))
    got = words.select("n", F.explode(pairs).alias("pair")).groupBy("pair").agg(F.sum("n").alias("n"))
    return {r.pair: r.n for r in got.collect()}  # at most 37 x 36 rows


class TextChain:
    """Text as a chain: letters given the letter before, changes between letters and digits, ends of words."""

    def __init__(self, pairs: dict[str, int]):
        single = Counter()
        for pair, n in pairs.items():
            single[pair[1]] += n
        total, fixed = sum(single[c] for c in LETTERS), sum(TEXT_LETTERS.values())
        prior = np.array([TEXT_LETTERS[c] / fixed for c in LETTERS])
        alone = (np.array([single[c] for c in LETTERS]) + 200 * prior) / (total + 200)
        rows = np.array([[pairs.get(a + c, 0) for c in LETTERS] for a in LETTERS], dtype=float)
        after = (rows + 50 * alone) / (rows.sum(1, keepdims=True) + 50)
        #: chances of a letter, and of a letter after each letter, flattened: names differ from the corpus
        self.alone = 0.8 * alone + 0.2 * prior
        self.after = 0.6 * after + 0.2 * alone + 0.2 * prior
        words = sum(n for pair, n in pairs.items() if pair[0] == " ")
        self.end = 1 / min(WORD_LENGTH, max(1.0, sum(pairs.values()) / words if words else WORD_LENGTH))

        def turn(before: str, to: str) -> float:
            every = sum(n for pair, n in pairs.items() if pair[0] in before)
            return min(0.5, sum(n for pair, n in pairs.items() if pair[0] in before and pair[1] in to) / max(1, every))

        self.to_digit, self.to_letter = turn(LETTERS, DIGITS), turn(DIGITS, LETTERS)

    def within(self, alphabet: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The alphabet's letters, and their chances alone and after each letter, among themselves."""
        here = np.array([c in alphabet.lower() for c in LETTERS])
        return here, *(np.where(here, x, 0) / np.where(here, x, 0).sum(-1, keepdims=True) for x in (self.alone, self.after))

    def scores(self, alphabet: str) -> tuple[np.ndarray, np.ndarray]:
        """Log ratio to uniform of each letter, and of each pair to its letters (0 outside the alphabet)."""
        here, alone, after = self.within(alphabet)
        with np.errstate(divide="ignore", invalid="ignore"):
            letter = np.where(here, np.log(alone * here.sum()), 0.0)
            pair = np.where(here[:, None] & here, np.log(after / alone), 0.0)
        return letter, pair

    def draw(self, alphabet: str, size: int, floor: float, capital: bool, parted: bool, m: int = DRAWN):
        """``m`` strings as (place of the character, its class): 0-25 letters, 26 digits, 27 symbols."""
        rnd = np.random.default_rng(5)
        _, alone, after = self.within(alphabet)
        table = np.cumsum(np.vstack([after, alone, alone]), axis=1)  # rows: after a letter, a digit, a symbol or word's end
        to_digit, to_letter = max(floor, self.to_digit), max(floor, self.to_letter)
        out, kind = np.empty((m, size), int), np.empty((m, size), int)
        last = np.full(m, 27)
        for i in range(size):
            u, v, w = rnd.random((3, m))
            ends = (last != 27) & (w < self.end) if i else np.zeros(m, bool)
            start = ends | (last == 27)
            row = np.where(start, 27, last)
            letter = np.minimum((table[row] < u[:, None] * table[row][:, -1:]).sum(1), 25)
            digit = np.where(last == 26, v >= to_letter, v < to_digit)
            got = np.where(digit, 26, letter)
            if parted:
                got = np.where(ends, 27, got)
            out[:, i] = got
            kind[:, i] = np.where(got < 26, np.where(start & capital, 1, 0), got)
            last = got
        return out, kind


def _measures(place: np.ndarray, kind: np.ndarray, letter: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of terms of each test for each drawn string."""
    a, b = place[:, :-1], place[:, 1:]
    both = (a < 26) & (b < 26)
    sums = [np.where(place < 26, letter[np.minimum(place, 25)], 0).sum(1), (kind[:, 1:] != kind[:, :-1]).sum(1),
            np.where(both, pair[np.minimum(a, 25), np.minimum(b, 25)], 0).sum(1)]
    counts = [(place < 26).sum(1), np.full(len(place), place.shape[1] - 1), both.sum(1)]
    return np.stack(sums).astype(float), np.stack(counts).astype(float)


def _random_means(alphabet: str, letter: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean term of each test for random characters, and its terms per character."""
    here = np.array([c in alphabet.lower() for c in LETTERS])
    k = len(alphabet)
    groups = [sum(c in x for c in alphabet) for x in (LETTERS, LETTERS.upper(), DIGITS, "+/")]
    share = 1 - sum(c in DIGITS + "+/" for c in alphabet) / k
    return (np.array([letter[here].mean(), 1 - sum((g / k) ** 2 for g in groups), pair[np.ix_(here, here)].mean()]),
            np.array([share, 1.0, share * share]))


def _normal_score(x, skew):
    """Normal score of a standardised value of a skewed distribution (Wilson-Hilferty); numpy."""
    g = np.where(np.abs(skew) < 1e-3, 1e-3, skew)
    return 6 / g * (np.cbrt(np.maximum(g * x / 2 + 1, 1e-6)) - 1) + g / 6


def text_null(pairs: dict[str, int], tests: tuple[str, ...] = TESTS) -> list[dict]:
    """Per (encoding, length band, way of writing): ``mean``, ``sd`` and ``skew`` of a term and ``weight`` of each test.

    ``sd`` and ``skew`` are those of one term, so that n terms have ``sd * sqrt(n)`` and ``skew / sqrt(n)``.
    The sign is such that a larger value is more random.  Tests left out weigh nothing.
    """
    chain, out = TextChain(pairs), []
    sign = np.array([-1.0, 1.0, -1.0])
    used = np.array([t in tests for t in TESTS])
    for enc, alphabet in enumerate(ENCODINGS):
        letter, pair = chain.scores(alphabet)
        cased, symbols = alphabet in (BASE62, BASE64), alphabet == BASE64
        far, per_char = _random_means(alphabet, letter, pair)
        for floor in (0.0, TEXT_TURN):
            for capital in (False, True)[:1 + cased]:
                for parted in (False, True)[:1 + symbols]:
                    place, kind = chain.draw(alphabet, LENGTH_BANDS[-1], floor, capital, parted)
                    for band, n in enumerate(LENGTH_BANDS):
                        sums, counts = _measures(place[:, :n], kind[:, :n], letter, pair)
                        mean = sums.sum(1) / np.maximum(counts.sum(1), 1)
                        root = np.sqrt(np.maximum(counts, 1))
                        dev = sign[:, None] * (sums - mean[:, None] * counts) / root
                        sd = np.maximum(dev.std(1), 0.2)
                        typical = np.sqrt(np.maximum(per_char * n, 1))
                        skew = np.clip(((dev / sd[:, None]) ** 3).mean(1), -2, 2) * typical
                        z = _normal_score(dev / sd[:, None], skew[:, None] / root)
                        corr = np.cov(z)
                        corr += np.diag(np.maximum(1 - np.diag(corr), 0))  # a test that hardly varies still has a unit score
                        shift = np.maximum(sign * (far - mean) * typical / sd, 0)
                        keep = np.ix_(used, used)
                        weight = np.zeros(3)
                        weight[used] = np.maximum(np.linalg.solve(corr[keep], shift[used]), 0)
                        size = math.sqrt(max(weight @ corr @ weight, 1e-12))
                        at = float(weight @ z.mean(1)) / size
                        out.append({"enc": enc, "band": band, "mean": mean.tolist(), "sd": sd.tolist(), "skew": skew.tolist(),
                                    "weight": (weight / size).tolist(), "at": at, "sign": sign.tolist()})
    return out


def _sums(token: Column, chain: TextChain) -> Column:
    """Struct of the sums and numbers of terms of the three tests (as arrays ``sum`` and ``n``) and the encoding ``enc``."""
    size = 28
    tables = {}
    for alphabet in (HEX, BASE32, BASE62):  # base64 has the letters of base62
        letter, pair = chain.scores(alphabet)
        full = np.zeros((size, size))
        full[:26, :26] = pair
        tables[alphabet] = tuple(F.array(*[F.lit(float(v)) for v in t.ravel()]) for t in (np.append(letter, [0.0, 0.0]), full))

    def split(x: Column) -> Column:
        folded = F.translate(F.lower(x["t"]), DIGITS + "+/", "~" * 10 + "||")
        kinds = F.translate(x["t"], LETTERS + LETTERS.upper() + DIGITS + "+/", "l" * 26 + "U" * 26 + "0" * 10 + "++")
        order = F.lit(LETTERS + "~|")
        return F.struct(F.transform(F.split(folded, ""), lambda c: F.instr(order, c) - 1).alias("p"), F.split(kinds, "").alias("k"))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)

    def of(alphabet: str, s: Column) -> Column:
        letter, pair = tables[alphabet]
        p, k, n = s["p"], s["k"], F.size(s["p"])
        back = F.slice(p, F.lit(1), n - 1)
        ahead = F.slice(p, F.lit(2), n - 1)
        changes = F.zip_with(F.slice(k, F.lit(1), n - 1), F.slice(k, F.lit(2), n - 1),
                             lambda a, b: F.when(a == b, F.lit(0.0)).otherwise(F.lit(1.0)))
        both = F.zip_with(back, ahead, lambda a, b: F.when((a < 26) & (b < 26), F.lit(1.0)).otherwise(F.lit(0.0)))
        return F.struct(
            F.array(total(F.transform(p, lambda c: F.get(letter, c))), total(changes),
                    total(F.zip_with(back, ahead, lambda a, b: F.get(pair, a * size + b)))).alias("sum"),
            F.array(F.size(F.filter(p, lambda c: c < 26)).cast("double"), (n - 1).cast("double"), total(both)).alias("n"))

    def rest(x: Column) -> Column:
        return let(split(x), lambda s: F.when(F.lower(x["a"]) == HEX, of(HEX, s)).when(x["a"] == BASE32, of(BASE32, s))
                   .otherwise(of(BASE62, s)))

    enc = lambda a: (F.when(F.lower(a) == HEX, 0).when(a == BASE32, 1).when(a == BASE62, 2).otherwise(3))
    return let(_core(token), lambda x: F.struct(rest(x).alias("s"), enc(x["a"]).alias("enc")))


def _p_value(s: Column, way: Column) -> Column:
    """p of a token's sums under one way of writing text."""
    score = F.lit(0.0)
    for i in range(len(TESTS)):
        n = F.get(s["n"], F.lit(i))
        part = lambda name: F.get(way[name], F.lit(i))  # noqa: E731, B023
        x = part("sign") * (F.get(s["sum"], F.lit(i)) - part("mean") * n) / (part("sd") * F.sqrt(n))
        skew = part("skew") / F.sqrt(n)
        g = F.when(F.abs(skew) < 1e-3, F.lit(1e-3)).otherwise(skew)
        z = F.lit(6.0) / g * (F.cbrt(F.greatest(g * x / 2 + 1, F.lit(1e-6))) - 1) + g / 6
        score = score + F.when(n > 0, part("weight") * z).otherwise(F.lit(0.0))
    return far_tail(score - way["at"])


def _band(n: Column) -> Column:
    return sum((F.when(n >= low, 1).otherwise(0) for low in LENGTH_BANDS[1:]), F.lit(0))


_NULL = ("array<struct<enc:int,band:int,mean:array<double>,sd:array<double>,skew:array<double>,"
         "weight:array<double>,at:double,sign:array<double>>>")


def text_p(tokens: DataFrame, pairs: dict[str, int], tests: tuple[str, ...] = TESTS) -> DataFrame:
    """``tokens`` (column ``m``) with ``band`` (length) and ``p``: the combined p-value of the tests against text.

    The null is a constant of at most encodings x bands rows, held in the plan.
    """
    ways = F.from_json(F.lit(json.dumps(text_null(pairs, tests))), _NULL)
    marked = tokens.withColumn("__s", _sums(F.col("m"), TextChain(pairs))).withColumn(
        "band", _band(F.get(F.col("__s.s.n"), F.lit(1)) + 1))
    mine = let(F.struct("__s", "band"), lambda x: F.array_max(F.transform(
        F.filter(ways, lambda w: (w["enc"] == x["__s"]["enc"]) & (w["band"] == x["band"])),
        lambda w: _p_value(x["__s"]["s"], w))))
    return marked.withColumn("p", mine).drop("__s")


def accept(candidates: DataFrame, pairs: dict[str, int], fdr: float = 0.01, alpha: float = 0.002,
           tests: tuple[str, ...] = TESTS) -> DataFrame:
    """The ``random`` candidates that pass the battery and the false-discovery control.

    ``pairs``: see :func:`text_pairs`; ``tests``: those whose p-values are combined.  p-values are rounded up to powers of
    1/sqrt(2), so the control needs only a count per (length band, power): at most bands x ``_LOG_BINS`` rows, whatever the input.
    """
    limit = alpha / 3
    plausible = ((normal_tail(F.col("b.chi")) >= limit) & (normal_tail(F.col("b.runs")) >= limit / 2)
                 & (normal_tail(F.abs(F.col("b.serial"))) >= limit / 2))
    power = F.greatest(F.lit(0), F.least(F.lit(_LOG_BINS), F.floor(-2 * F.log2(F.greatest("p", F.lit(1e-12)))))).cast("int")
    tested = (text_p(candidates, pairs, tests).withColumn("b", battery(F.col("m"))).withColumn("plausible", plausible)
              .withColumn("power", F.when(F.col("plausible"), power).otherwise(F.lit(0))))
    per = tested.groupBy("band", "power").agg(F.count(F.lit(1)).alias("c"))
    down = Window.partitionBy("band").orderBy(F.desc("power"))
    cut = (per.withColumn("above", F.sum("c").over(down)).withColumn("all", F.sum("c").over(Window.partitionBy("band")))
           .where((F.pow(F.lit(2.0), -F.col("power") / 2) * F.col("all") <= fdr * F.col("above")) & (F.col("power") > 0))
           .groupBy("band").agg(F.min("power").alias("least")))
    # one row per length band at most
    return (tested.join(F.broadcast(cut), "band").where(F.col("plausible") & (F.col("power") >= F.col("least")))
            .select(*candidates.columns))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = 0.01) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``n_random``, ``base``, ``found``.

    ``base`` and ``found`` are arrays of ``struct(start, kind, end)`` in order (kind as its
    place in ``KINDS``): the base spans, and all spans.  Null text counts as empty.
    """
    every = materialize(spans(docs, id_col, text_col), "secret-spans")
    before = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    marked = every.withColumn("covered", F.max(F.when(F.col("kind") < 3, F.col("end"))).over(before) > F.col("start"))
    free = marked.where((F.col("kind") == 3) & ~F.coalesce("covered", F.lit(False))).drop("covered")
    picked = accept(free, text_pairs(docs, text_col), fdr).select("row", "doc_id", "kind", "start", "end")
    base = every.where("kind is null or kind < 3").select("row", "doc_id", "kind", "start", "end")
    one = F.struct("start", "kind", "end")
    counts = [F.count(F.when(F.col("kind") == i, 1)).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return (base.unionByName(picked).groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), *counts,
        F.sort_array(F.collect_list(F.when(F.col("kind") < 3, one))).alias("base"),
        F.sort_array(F.collect_list(F.when(F.col("kind").isNotNull(), one))).alias("found")).drop("row"))


def written(found: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")
