import hashlib
import random
from collections import defaultdict

import numpy as np

from clickstream.llm.line_dedup import CuckooFilter, build_state, clean, delete_documents, insert_documents

WS = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line).strip(WS)


def brute(rows, counted=None, min_chars=40, min_docs=5):
    holders = defaultdict(set)
    for i, t in rows if counted is None else counted:
        for line in (t or "").split("\n"):
            if len(key_of(line)) >= min_chars and i is not None:
                holders[key_of(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (i is not None and len(key_of(x)) >= min_chars
                                         and len(holders[key_of(x)]) >= min_docs and i < max(holders[key_of(x)]))]
        text = "\n".join(kept)
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(n=60, seed=1):
    rnd = random.Random(seed)
    shared = [("Ärger é " * 6)[:k] + f"shared line number {j} xxxxxxxxxxxxxxxx" for j, k in enumerate([0, 3, 30, 40])]
    short = "ä" * 39  # more than 40 bytes, 39 code points
    rows = []
    for i in range(n):
        lines = [f"own line {i} " + "z" * rnd.randint(0, 60)]
        for s in shared + [short, "x" * 40, "y" * 39]:
            if rnd.random() < 0.3:
                lines.insert(rnd.randint(0, len(lines)), rnd.choice(["", "  ", "\t"]) + (s.upper() if rnd.random() < .3 else s) + rnd.choice(["", " \r"]))
        if rnd.random() < 0.2:
            lines += [lines[0], ""]
        rows.append((i, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "\n\n"), (3, "x" * 40), (None, "x" * 40), (103, "q\n" * 50000),
             (104, "L" * 2_000_000)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "k", 0) for i, t in rows], "doc_id long, text string, lines string, gone int")


def got(state, docs):
    out = clean(state, docs.select("doc_id", "text"))
    return sorted(((r.doc_id, r.lines.n_lines, r.lines.n_dropped, r.lines.kept_sha256) for r in out.collect()), key=str)


def test_matches_brute_force(llm):
    rows = rows_of()
    docs = frame(llm, rows)
    assert got(build_state(docs, n_shards=3), docs) == brute(rows)


def test_delete_undoes_insert(llm):
    rows = rows_of()
    first, more = rows[:25], [(i, t) for i, t in rows[25:] if i is None or i >= 25]
    a, b = frame(llm, first), frame(llm, more)
    before = build_state(a, n_shards=2)
    after = insert_documents(before, b)
    assert got(after, a) == brute(first, first + more)
    assert got(after, b) == brute(more, first + more)
    back = delete_documents(after, b.where("doc_id is not null"))
    assert got(back, a) == brute(first)
    assert sorted(back.refs.collect()) == sorted(before.refs.collect())
    gone = delete_documents(back, a)
    assert gone.postings.count() == 0 and got(gone, a) == brute(first, [])


def test_extra_columns_stay(llm):
    docs = frame(llm, [(1, "a"), (2, None)]).drop("lines").withColumnRenamed("gone", "row")
    out = clean(build_state(docs), docs)
    assert out.columns == ["doc_id", "text", "row", "lines"] and out.count() == 2


def test_empty_table(llm):
    docs = llm.createDataFrame([], "doc_id long, text string")
    assert clean(build_state(docs), docs).count() == 0


def test_cuckoo_filter_insert_delete():
    rng = np.random.default_rng(1)
    k = rng.integers(-2**63, 2**63 - 1, (2, 5000))
    f = CuckooFilter.sized(5000)
    assert f.insert(k[0, :4000], k[1, :4000]) and f.contains(k[0, :4000], k[1, :4000]).all()
    assert f.contains(k[0, 4000:], k[1, 4000:]).mean() < 0.01
    f.delete(k[0, :2000], k[1, :2000])
    assert f.contains(k[0, 2000:4000], k[1, 2000:4000]).all()
    assert f.contains(k[0, :2000], k[1, :2000]).mean() < 0.01
    g = CuckooFilter.load(f.dump())
    assert (g.slots == f.slots).all()
    f.delete(k[0, 2000:4000], k[1, 2000:4000])
    assert not f.slots.any()
