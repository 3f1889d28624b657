import random

from pyspark.sql import functions as F

from clickstream.llm import toxicity as T
from clickstream.llm.common import held_out


def brute_clause(kinds, weights):
    """The four transducers by their definition: scopes and latches recomputed at every word."""
    total, aimed = 0.0, T.TARGET in kinds
    for i, (k, w) in enumerate(zip(kinds, weights)):
        if not w or not (k == T.INSULT or aimed):
            continue
        before = kinds[:i]
        f = 1.0
        if T.NEGATION in before[-T.NEGATION_SCOPE:]:
            f *= T.NEGATED
        if T.REPORT in before:
            f *= T.REPORTED
        if T.TARGET in before:
            f *= T.WITH_TARGET
        total += w * f
    return total


def test_product_transducer_matches_definition():
    rnd = random.Random(1)
    word = {T.OTHER: "stone", T.INSULT: "scum", T.THREAT: "kill", T.TARGET: "you", T.NEGATION: "not", T.REPORT: "said"}
    lex = T.Lexicon({"=scum": 2.0})
    for _ in range(300):
        kinds = [rnd.randrange(6) for _ in range(rnd.randint(1, 9))]
        weights = [{T.INSULT: 2.0, T.THREAT: T.THREAT_WEIGHT}.get(k, 0.0) for k in kinds]
        want = brute_clause(kinds, weights)
        got = T.clause_scores(" ".join(word[k] for k in kinds), lex)
        assert abs(sum(got) - want) < 1e-9


def test_grammar_orders_cases():
    lex = T.Lexicon({"=scum": 2.0, "^vequ": 3.0})
    s = lambda t: T.document_signal(t, lex)
    assert s("you are scum") > s("scum") > s("they said: x said scum") and s("not scum") < s("scum")
    assert s("vequaire") == 3.0 and s("kill the process") == 0 and s("I will kill you") > 0
    assert s("not good. scum") == s("scum") and s(None) == s("") == 0


def _rows():
    rnd = random.Random(3)
    vocab = ["".join(rnd.choice("aeioubcdlmnprst") for _ in range(rnd.randint(2, 9))) for _ in range(600)]
    rows, labels = [], []
    for i in range(900):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(5, 80))]
        toxic = i % 7 == 0
        if toxic:
            for _ in range(3):
                words.insert(rnd.randint(0, len(words)), rnd.choice(["scum", "idiot", "zzqu" + rnd.choice(vocab)]))
        rows.append((i, " ".join(words)))
        if i % 3:
            labels.append((i, int(toxic)))
    return rows, labels


def test_learns_and_holds_out(llm):
    rows, labels = _rows()
    docs = llm.createDataFrame([(i, t, 0.0, "m") for i, t in rows], "doc_id long, text string, score double, model string")
    lab = llm.createDataFrame(labels + [(1, None), (None, 1), (2, 0)], "doc_id long, toxic int")
    model = T.fit(docs, lab, usable=~held_out(F.col("doc_id")))
    assert "=scum" in model.insults and "^zzqu" in model.insults
    got = docs.select("doc_id", held_out(F.col("doc_id")).alias("h"), T.toxicity_score(F.col("text"), model).alias("s")).collect()
    held = [r for r in got if r.h]
    right = sum((r.s >= 0.5) == (r.doc_id % 7 == 0) for r in held)
    assert right >= 0.97 * len(held) and all(0 <= r.s <= 1 for r in got)
    kept = T.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.where("doc_id % 7 != 0").count() >= 0.98 * docs.where("doc_id % 7 != 0").count()
    # the held-out labels do not matter
    flipped = lab.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert T.fit(docs, flipped, usable=~held_out(F.col("doc_id"))) == model


def test_bounded_sample(llm):
    rows, labels = _rows()
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    model = T.fit(docs, llm.createDataFrame(labels, "doc_id long, toxic int"), max_fit_rows=300, min_docs=3)
    assert "=scum" in model.insults


def test_odd_texts_and_empty_tables(llm):
    docs = llm.createDataFrame([(1, None), (1, ""), (2, "scum " * 50_000), (None, "x")], "doc_id long, text string")
    labels = llm.createDataFrame([], "doc_id long, toxic int")
    model = T.fit(docs, labels)
    out = docs.select(T.toxicity_score(F.col("text"), model).alias("s")).collect()
    assert len(out) == 4 and all(0 <= r.s < 0.5 for r in out)
    assert T.drop_toxic(docs.where("false"), model).count() == 0
    trained = T.ToxicityModel({"=scum": 5.0}, 1.0, -4.0)
    assert T.drop_toxic(docs, trained).count() == 3


def test_one_aimed_threat_decides(llm):
    rows, labels = _rows()
    texts = ["I will kill you", "We will kill you and murder your people", "Ich werde dich töten", "They will kill you. We destroy them.",
             "kill the process", "I will not kill you", "he said he will kill you", "a quiet day"]
    learn = llm.createDataFrame(rows, "doc_id long, text string")
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for lab in (labels, []):
        model = T.fit(learn, llm.createDataFrame(lab, "doc_id long, toxic int"))
        got = [r.s for r in docs.orderBy("doc_id").select(T.toxicity_score(F.col("text"), model).alias("s")).collect()]
        assert all(s >= 0.5 for s in got[:4]) and all(s < 0.5 for s in got[4:]), got


def test_labels_overrule_the_threat_prior(llm):
    rows, labels = _rows()
    rows += [(5000 + i, "we beat them all again") for i in range(40)]
    model = T.fit(llm.createDataFrame(rows, "doc_id long, text string"),
                  llm.createDataFrame(labels + [(5000 + i, 0) for i in range(40)], "doc_id long, toxic int"))
    docs = llm.createDataFrame([(1, "we beat them all again")], "doc_id long, text string")
    assert docs.select(T.toxicity_score(F.col("text"), model).alias("s")).first().s < 0.5
