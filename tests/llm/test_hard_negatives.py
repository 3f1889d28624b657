import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickstream.llm.hard_negatives import LEVELS, Best, Rows, add_positives, bounds, mine, pair_bounds

SCHEMA = "vec_id long, label int, vector array<float>, id string, score int"


def brute(rows, every=5, positives=5, negatives=3):
    ok = [(i, lab, [math.floor(256 * float(np.float32(x))) for x in v]) for i, lab, v in rows
          if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a in {(i, lab, tuple(v)) for i, lab, v in ok if i % every == 0}:
        score = lambda r: sum(x * y for x, y in zip(a[2], r[2]))
        order = lambda rs: sorted(rs, key=lambda r: (-score(r), r[0]))
        for p in order(r for r in ok if r[0] != a[0] and r[1] == a[1])[:positives]:
            fit = [r for r in ok if r[0] != a[0] and r[1] != a[1] and 50 * score(p) <= 100 * score(r) <= 95 * score(p)]
            out += [(a[0], p[0], k + 1, n[0], score(p), score(n)) for k, n in enumerate(order(fit)[:negatives])]
    return sorted(out)


def make(seed, n=240, dim=20):
    rnd = random.Random(seed)
    centre = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    base = [0.5] * dim
    rows = []
    for i in range(n):
        lab = rnd.choice([0, 0, 1, 2])
        rows.append((i, lab, [b + 0.4 * c + rnd.gauss(0, 0.3) for b, c in zip(base, centre[lab])]))
    rows += [(1000 + k, k % 3, rows[7][2]) for k in range(30)]  # copies: ties by id
    rows += [(1100, None, rows[1][2]), (1105, 1, None), (1110, 1, [float("nan")] * dim), (1115, 1, [float("inf")] + [0.0] * (dim - 1)),
             (1120, 2, [None] * dim), (1125, 1, [1.0, 2.0]), (1130, 0, []), (None, 1, rows[2][2]), rows[3], rows[10], rows[10]]
    return rows


def frame(llm, rows):
    return llm.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def got(df):
    return sorted(map(tuple, df.collect()))


def test_matches_brute_force(llm):
    for seed in (1, 2):
        rows = make(seed)
        df = frame(llm, rows)
        want = brute(rows)
        assert len(want) > 300
        assert got(mine(df, F.col("vec_id") % 5 == 0)) == want
        assert got(mine(df.repartition(5), F.col("vec_id") % 5 == 0, block_anchors=9)) == want


def test_empty_tables_and_odd_numbers(llm):
    df = frame(llm, make(3))
    assert mine(df.where("false"), F.col("vec_id") % 5 == 0).count() == 0
    assert mine(df, F.lit(False)).count() == 0
    assert mine(df.where("label = 1"), F.col("vec_id") % 5 == 0).count() == 0
    assert mine(df.where("size(vector) = 0"), F.col("vec_id") % 5 == 0).count() == 0
    wide = [(k, k % 2, [2.0**21 + 512 * k, 2.0**20 - 256 * k]) for k in range(1, 40)]  # beyond exact doubles
    assert got(mine(frame(llm, wide), F.col("vec_id") % 5 == 0, low=10, high=100)) and got(
        mine(frame(llm, wide), F.col("vec_id") % 5 == 0)) == brute(wide)


def test_bounds_hold_and_leave_pairs_out():
    rng = np.random.default_rng(5)
    a, b = (Rows(np.floor(256 * (rng.normal(size=(n, 64)) * 0.1 + np.repeat(rng.normal(size=(n, 4)), 16, axis=1)))) for n in (40, 300))
    true = a.q @ b.q.T
    i, j = (x.ravel() for x in np.meshgrid(np.arange(40), np.arange(300), indexing="ij"))
    width = []
    for level in range(len(LEVELS)):
        low, high = bounds(a, b, level)
        assert (low <= true).all() and (true <= high).all()
        p, q = pair_bounds(a, b, level, i, j)
        assert (p <= true.ravel()).all() and (true.ravel() <= q).all()
        width.append((high - low).mean())
    assert width[1] < width[0]
    import clickstream.llm.hard_negatives as H
    scored = []
    kept = H.exact
    try:
        H.exact = lambda x, y, i, j: (scored.append(len(i)), kept(x, y, i, j))[1]
        best, label = Best(40, 5), np.zeros(40, int)
        for s in range(0, 300, 50):
            add_positives(best, a, np.arange(40) + 900, label, H._take(b, np.arange(s, s + 50)), np.arange(s, s + 50), np.zeros(50, int))
    finally:
        H.exact = kept
    assert sum(scored) < 0.6 * true.size  # the summaries spare exact scores
    want = np.sort(true, axis=1)[:, -5:].ravel()
    assert sorted(best.score.tolist()) == sorted(want.astype(int).tolist())


def test_scores_beyond_64_bits_are_an_error():
    big = Rows(np.full((1, 2), 2.0**70))
    with pytest.raises(OverflowError):
        __import__("clickstream.llm.hard_negatives", fromlist=["exact"]).exact(big, big, np.array([0]), np.array([0]))
