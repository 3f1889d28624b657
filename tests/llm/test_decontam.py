import random
import re

from clickstream.llm.decontam import contamination, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, window=10):
    out = []
    for i, t in docs:
        w = words(t)
        hit, ids = set(), set()
        for item, it in items:
            v = words(it)
            for k in range(max(1, len(v) - window + 1) if v else 0):
                x = v[k:k + window]
                for a in range(len(w) - len(x) + 1):
                    if w[a:a + len(x)] == x:
                        hit.update(range(a, a + len(x)))
                        ids.add(item)
        out.append((i, len(w), len(hit), sorted(str(x) for x in ids if x is not None), bool(hit)))
    return sorted(out, key=str)


def make(seed=0):
    rnd = random.Random(seed)
    vocab = ["the", "of", "a", "Ähre", "naïve", "x1", "Data", "spark", "q", "42"] + [f"w{k}" for k in range(40)]
    items = [(k, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([4, 10, 11, 25])))) for k in range(12)]
    items += [(50, None), (51, ""), (52, "-- !!"), (53, items[3][1]), (None, "solo words here"), (54, "the the the the the the the the the the the the")]
    docs = []
    for i in range(80):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 2)):
            v = words(rnd.choice(items)[1])
            a = rnd.randint(0, max(0, len(v) - 8))
            at = rnd.randint(0, len(w))
            w[at:at] = v[a:a + rnd.choice([9, 10, 13])]
        docs.append((i, rnd.choice([" ", ", ", "\n"]).join(w).upper() if rnd.random() < 0.3 else " - ".join(w)))
    docs += [(100, None), (101, ""), (102, "the " * 3000), (5, "solo WORDS, here!"), (None, items[1][1]),
             (103, "z" * 1_500_000 + " " + items[2][1]), (104, "solo words"), (105, "here solo words here")]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, 1, "a") for i, t in docs], "doc_id long, text string, n_words int, hits string"),
            spark.createDataFrame(items, "item_id long, text string"))


def rows(df):
    return sorted(((r.doc_id, r.leak.n_words, r.leak.n_hit, list(r.leak["items"]), r.leak.contaminated)
                   for r in df.collect()), key=str)


def test_matches_brute_force(llm):
    docs, items = make()
    d, b = frames(llm, docs, items)
    want = brute(docs, items)
    assert sum(r[4] for r in want) > 20 and not all(r[4] for r in want)
    assert rows(contamination(d, b)) == want
    assert rows(contamination(d, b, block_windows=20)) == want
    kept = decontaminate(d, b)
    assert kept.columns == d.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in want if not r[4])


def test_empty_tables(llm):
    d, b = frames(llm, *make())
    none = b.where("false")
    assert contamination(d, none).where("leak.contaminated").count() == 0
    assert contamination(d.where("false"), b).count() == 0


def test_window_length(llm):
    docs, items = make(3)
    d, b = frames(llm, docs, items)
    assert rows(contamination(d, b, window=3)) == brute(docs, items, 3)
