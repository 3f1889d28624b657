import math
import random
import re
from collections import Counter

import numpy as np

from clickstream.llm.lexical_search import Plan, search

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(t or "")]


def brute(docs, items, top=20):
    words = [terms(t) for _, t in docs]
    big_n, big_l = sum(1 for w in words if w), sum(map(len, words))
    df = Counter(x for w in words for x in set(w))
    out = []
    for item, text in items:
        own, scored = Counter(terms(text)), []
        for (d, _), w in zip(docs, words):
            tf, m, s = Counter(w), 75 + (25 * len(w) * big_n) // max(1, big_l), 0
            for t, times in own.items():
                if tf[t]:
                    s += times * math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 12 * m))
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def make(seed):
    rnd = random.Random(seed)
    vocab = ["the", "Of", "naïve", "Ähre", "x1", "42", "日本", "a"] + [f"w{k}" for k in range(60)]
    some = lambda n: rnd.choice([" ", ", ", "\n", "__"]).join(rnd.choice(vocab) for _ in range(n))
    docs = [(i * 3 % 200, some(rnd.choice([0, 1, 5, 40, 90]))) for i in range(180)]
    docs += [(None, some(30)), (None, None), (500, None), (501, ""), (502, "!! --"), (7, docs[3][1]), (7, docs[3][1]), (503, "w1 " * 30_000)]
    phrase = some(6)
    items = [(k, some(rnd.choice([1, 6, 20])) + " " + (phrase if k % 3 else "")) for k in range(25)]
    return docs, items + [(None, "w1 w2 w2 w2"), (3, "w1 w2 w2 w2"), (90, None), (91, "..."), (92, "absent words"), (93, "THE of of")]


def rows(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def frames(llm, docs, items):
    return (llm.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, n long, id string"),
            llm.createDataFrame([(*i, 0) for i in items], "item_id long, text string, rank int"))


def test_matches_brute_force(llm):
    docs, items = make(1)
    d, b = frames(llm, docs, items)
    want = brute(docs, items)
    assert rows(search(d, b)) == want and len(want) > 300
    assert rows(search(d, b, block_items=4)) == want
    assert rows(search(d.repartition(7), b, top=3)) == brute(docs, items, 3)


def test_empty_tables(llm):
    d, b = frames(llm, *make(2))
    assert search(d.where("false"), b).count() == 0
    assert search(d, b.where("false")).count() == 0
    assert search(d, b.where("item_id = 92")).count() == 0


def test_shared_parts_are_added_once():
    rnd = random.Random(3)
    common = {k: 1 for k in range(40)}
    items = [{**{k: v for k, v in common.items() if rnd.random() < 0.9}, **{100 + rnd.randrange(200): rnd.choice([1, 2]) for _ in range(5)}}
             for _ in range(60)] + [{}, {5: 1}]
    plan = Plan(items)
    plain = sum(max(0, len(i) - 1) for i in items)
    assert plan.additions() < 0.5 * plain
    value = {leaf: rnd.randrange(1000) for leaf in plan.leaves}
    got = plan.scores(np.array([[value[leaf]] for leaf in plan.leaves], np.int64))[:, 0]
    assert got.tolist() == [sum(value[leaf] for leaf in i.items()) for i in items]
    for k, members in enumerate(plan.nodes):  # a node uses earlier ones only
        assert max(members) < len(plan.leaves) + k
