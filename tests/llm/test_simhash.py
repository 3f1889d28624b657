import random

import numpy as np
import xxhash

from clickstream.llm.simhash import keep_one, local_links, near_duplicates, near_links, simhash, bands_for


def brute_fp(text, k=4):
    out, words, word = 0, [], ""
    for ch in (text or "") + " ":
        if ch in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch
    if not words:
        return 0
    grams = [" ".join(words)] if len(words) < k else [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    for b in range(64):
        if 2 * sum(h >> b & 1 for h in hs) > len(hs):
            out |= 1 << b
    return out


def brute_groups(keys, fps, radius):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if keys[i] == keys[j] and bin(int(fps[i]) ^ int(fps[j])).count("1") <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def same_partition(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def test_fingerprint_matches_brute_force():
    texts = [None, "", " \t\r\n\x0b\x0c", "One", "one TWO three", "a b c d", "Ä Á É x ö ß\x00y z",
             " ".join(random.Random(3).choice("aa bB cc ddd éé".split()) for _ in range(500)), "x " * 5]
    for t in texts:
        assert simhash(None if t is None else t.encode()) == brute_fp(t), t


def test_local_links_match_brute_force():
    rnd = random.Random(5)
    for trial in range(12):
        base = [rnd.getrandbits(64) for _ in range(6)]
        fps, keys = [], []
        for _ in range(rnd.choice([1, 40, 200, 400])):
            f = rnd.choice(base) if rnd.random() < 0.7 else rnd.getrandbits(64)
            for _ in range(rnd.randint(0, 7)):
                f ^= 1 << rnd.randrange(64)
            fps.append(f)
            keys.append(rnd.choice([1, 1, 1, 2, 3]))
        got = local_links(np.array(keys), np.array(fps, np.uint64), 4)
        assert same_partition(list(got), brute_groups(keys, fps, 4))


def test_bands_grow_with_the_table():
    assert bands_for(1000, 4) == (5, 1) and bands_for(1 << 25, 4) == (6, 2)


def _frame(spark, fps):
    signed = [(f - (1 << 64) if f >= 1 << 63 else f,) for f in fps]
    return spark.createDataFrame(signed, "fp long")


def test_links_reach_what_all_pairs_reach(llm):
    rnd = random.Random(11)
    centre = rnd.getrandbits(64)
    fps = {0}
    while len(fps) < 500:  # one dense group, a chain, and strangers
        f = centre
        for _ in range(rnd.randint(0, 3)):
            f ^= 1 << rnd.randrange(64)
        fps.add(f)
    chain = rnd.getrandbits(64)
    for k in range(0, 64, 2):
        chain ^= 3 << k
        fps.add(chain)
    fps |= {rnd.getrandbits(64) for _ in range(400)}
    fps = sorted(fps)
    want = brute_groups([0] * len(fps), fps, 4)
    for bands, tile in ((None, 4096), ((6, 2), 4096), (None, 60)):
        links = near_links(_frame(llm, fps), 4, tile=tile, bands=bands, cell_rows=500).collect()
        assert len(links) < 40 * len(fps)
        at = {f - (1 << 64) if f >= 1 << 63 else f: i for i, f in enumerate(fps)}
        parent = list(range(len(fps)))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for r in links:
            assert bin((r.a ^ r.b) & (1 << 64) - 1).count("1") >= 1
            a, b = find(at[r.a]), find(at[r.b])
            parent[max(a, b)] = min(a, b)
        assert same_partition([find(i) for i in range(len(fps))], want)


def _brute_docs(rows):
    fps = [brute_fp(t) for _, t in rows]
    rep = brute_groups([0] * len(rows), fps, 4)
    least = {}
    for (i, _), r in zip(rows, rep):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return sorted(((i, f"{f:016x}", least.get(r)) for (i, _), f, r in zip(rows, fps, rep)), key=str)


def test_documents_match_brute_force(llm):
    rnd = random.Random(2)
    vocab = [f"w{k}" for k in range(400)]
    rows = []
    for i in range(60):
        words = [rnd.choice(vocab) for _ in range(rnd.choice([3, 60, 300]))]
        rows.append((i * 3, " ".join(words)))
        if i % 4 == 0:
            words[rnd.randrange(len(words))] = "changed"
            rows.append((i * 3 + 1, "  ".join(words).upper()))
    rows += [(500, None), (501, ""), (502, " \n"), (500, "Zebra"), (None, "zebra"), (None, None), (7, "x" * 300000),
             (8, "ab cd " * 60000)]
    docs = llm.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, fp int, component_id string")
    got = near_duplicates(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == _brute_docs(rows)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    # one row of every group with an id: the groups of a repeated id are kept apart
    of = {c for _, _, c in _brute_docs(rows) if c is not None}
    want = sorted([*of, *(i for i, _ in rows if i is None)], key=str)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == want


def test_keep_one_tells_rows_of_one_id_apart(llm):
    a, b = "one two three four five six seven eight nine ten", "a text of another kind that nobody else has at all"
    rows = [(3, a, 1), (7, a, 2), (7, b, 3), (9, b, 4), (9, "z", 5), (9, "z", 6), (9, "Z ", 7), (None, a, 8), (None, a, 9), (11, None, 10), (11, "", 11)]
    kept = keep_one(llm.createDataFrame(rows, "doc_id long, text string, text_key int"))
    got = sorted(((r.doc_id, r.text, r.text_key) for r in kept.collect()), key=str)
    assert [(i, (t or "").strip().lower()) for i, t, _ in got] == [(11, ""), (3, a), (7, b), (9, "z"), (None, a), (None, a)]
    assert {k for i, _, k in got if i is None} == {8, 9}


def test_empty_table(llm):
    docs = llm.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(docs).count() == 0 and keep_one(docs).count() == 0
