import math
import random

from pyspark.sql import functions as F

from clickstream.llm import language_id as L
from clickstream.llm.common import held_out

SYLLABLES = {"en": ["the", "ing", "and", "er", "th"], "de": ["sch", "ung", "und", "ö", "ei"], "fr": ["eau", "que", "é", "les", "ou"]}


def rows():
    rnd = random.Random(5)
    out = []
    for i in range(400):
        lang = rnd.choice(list(SYLLABLES))
        words = ["".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(3, 40))]
        out.append((i, " ".join(words).capitalize(), lang if rnd.random() < 0.9 else None))
    return out


def frame(spark, data):
    return spark.createDataFrame([(*r, "en") for r in data], "doc_id long, text string, lang string, lang_pred string")


def brute_fit(data):
    """Counts by plain loops."""
    counts = {}
    for _, t, lang in data:
        for w in L._WORD.findall(t.lower()):
            if len(w) > L.LONGEST:
                continue
            terms = [(0, w)] + [(n, g) for n in L.ORDERS for g in L.grams_of(w, n)]
            for k, x in terms:
                counts.setdefault((lang, k), {}).setdefault(x, 0)
                counts[lang, k][x] += 1
    return counts


def test_held_out_accuracy_and_model(llm):
    data = rows()
    docs = frame(llm, data)
    model = L.fit(docs, usable=~held_out(F.col("doc_id")))
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("h"), L.predict(F.col("text"), model).alias("g")).collect()
    kept = [r for r in data if r[2] and r[0] not in {x.doc_id for x in out if x.h}]
    counts = brute_fit(kept)
    for w in list(model.words)[:50] + list(model.grams)[:50]:
        kind = 0 if w in model.words else len(w)
        got = (model.words if kind == 0 else model.grams)[w]
        for lang, v in zip(model.languages, got):
            own = counts[lang, kind]
            want = math.log((own.get(w, 0) + L.SMOOTH) / (sum(own.values()) + L.SMOOTH * len(own)))
            assert math.isclose(v, want, abs_tol=1e-9)
    truth = {i: lang for i, _, lang in data}
    held = [r for r in out if r.h and truth[r.doc_id]]
    assert len(held) > 40 and sum(r.g.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.g.score <= 1 for r in out)
    changed = docs.withColumn("lang", F.when(held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    assert L.fit(changed, usable=~held_out(F.col("doc_id"))) == model


def test_backoff_reaches_shorter_grams(llm):
    model = L.LanguageModel(("a", "b"), {"the": [-1.0, -5.0]}, {"he": [-2.0, -3.0], "x": [-9.0, -1.0]}, [0.0, 0.0])
    assert L.word_vector("the", model) == [-1.0, -5.0]
    assert L.word_vector("zhez", model) == [-2.0 - 4 * L.BACKOFF, -3.0 - 4 * L.BACKOFF]
    assert L.word_vector("zxz", model) == [-9.0 - 5 * L.BACKOFF, -1.0 - 5 * L.BACKOFF]
    assert L.word_vector("qq", model) == [0.0, 0.0] == L.word_vector("q" * 65, model)
    assert L.word_vector("x" * 65, model) == L.word_vector("x" * 5, model) == [-9.0 - 5 * L.BACKOFF, -1.0 - 5 * L.BACKOFF]


def test_totals_match_plain_sums():
    model = L.LanguageModel(("a", "b"), {"the": [-1.0, -5.0]}, {"h": [-2.0, -3.0]}, [0.0, 0.0])
    texts = ["The the hut", None, "", "12 ² _", "zz", "h " * 50_000]
    total, n = L.Scorer(model).totals(texts)
    assert n.tolist() == [3, 0, 0, 0, 1, 50_000]
    for t, row in zip(texts, total):
        want = [sum(L.word_vector(w, model)[k] for w in L._WORD.findall((t or "").lower()) if w != "²") for k in (0, 1)]
        assert all(math.isclose(x, y) for x, y in zip(row, want))


def test_undetermined_and_empty(llm):
    docs = frame(llm, [(1, None, "en"), (1, "123 ²!", None), (None, "the and", "en"), (2, "ü" * 100_000, "de"), (3, "", None)])
    model = L.fit(docs, min_count=1)
    got = docs.select("text", L.predict(F.col("text"), model).alias("g")).collect()
    assert [r.g.lang_pred == "und" for r in got] == [True, True, False, False, True]
    assert all(r.g.score == 0 for r in got if r.g.lang_pred == "und")
    none = L.fit(docs.where("false"))
    assert none.languages == () and docs.select(L.predict(F.col("text"), none).alias("g")).where("g.lang_pred != 'und'").count() == 0
    assert docs.where("false").select(L.predict(F.col("text"), model)).count() == 0


def test_bounded_sample(llm):
    model = L.fit(frame(llm, rows()), max_fit_rows=100, max_words=20, max_grams=30)
    assert len(model.words) <= 20 and len(model.grams) <= 30


def test_language_with_one_short_document_takes_no_other(llm):
    data = rows()
    for n in (5, 100):
        docs = frame(llm, data + [(10_000, " ".join(["kivu", "ampo", "zari", "wobe", "lumi"] * (n // 5)), "xx")])
        model = L.fit(docs, usable=~held_out(F.col("doc_id")) | (F.col("doc_id") == 10_000))
        assert "xx" in model.languages
        got = (docs.where(held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.col("lang") != "xx"))
               .select("lang", L.predict(F.col("text"), model).alias("g")).collect())
        assert len(got) > 40 and sum(r.g.lang_pred == r.lang for r in got) >= 0.97 * len(got)


def test_long_runs_and_many_languages(llm):
    """Runs beyond the stored words vote by n-grams; a bound on languages keeps whole languages."""
    rnd = random.Random(12)
    alphabets = {"aa": "abcdefgh", "bb": "hijklmno", "cc": "opqrstuv"}
    word = lambda x: "".join(rnd.choice(alphabets[x]) for _ in range(6))
    docs = [(i, " ".join(word(x) for _ in range(40 if x != "cc" else 10)), x) for i, x in enumerate(["aa", "bb", "cc"] * 30)]
    d = llm.createDataFrame(docs, "doc_id long, text string, lang string")
    model = L.fit(d)
    runs = [(1, "".join(word("bb") for _ in range(200)), "bb"), (2, "".join(word("cc") for _ in range(20_000)), "cc"),
            (3, "".join(word("aa") for _ in range(11)), "aa")]
    got = llm.createDataFrame(runs, "doc_id long, text string, lang string").select("lang", L.predict(F.col("text"), model).alias("p")).collect()
    assert all(r.p.lang_pred == r.lang and r.p.score > 0.5 for r in got)
    few = L.fit(d, max_languages=2)
    assert few.languages == ("aa", "bb")
    assert all(len(v) == 2 for v in few.grams.values()) and {len(g) for g in few.grams} == {1, 2, 3, 4, 5} and 0 in few.shared
    unspaced = [(i, "".join(word(x) for _ in range(60)), x) for i, x in enumerate(["aa", "bb"] * 20)]
    alone = L.fit(llm.createDataFrame(unspaced, "doc_id long, text string, lang string"))
    assert alone.languages == ("aa", "bb") and alone.grams and not alone.words
