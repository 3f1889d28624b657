import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import helpers as H
from clickstream.operators.sequence import (
    blocks, burst, consecutive, follow_distinct, n_in_span, threshold_then_next,
)

SCHEMA = "user long, ts timestamp_ntz, seq long, kind string, value double, who long"


def _random_rows(seed, n=400, users=4, horizon=3000):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append({"user": rnd.randrange(users), "ts": H.ts(rnd.randrange(horizon)), "seq": i,
                     "kind": rnd.choice(["fail", "fail", "ok"]), "value": float(rnd.randrange(1000)),
                     "who": rnd.randrange(3)})
    return rows


def _df(spark, rows):
    return spark.createDataFrame([(r["user"], r["ts"], r["seq"], r["kind"], r["value"], r["who"]) for r in rows],
                                 SCHEMA)


def _tuples(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


SEEDS = [1, 2, 3]
W = dt.timedelta(seconds=40)


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("chunk", [None, 40, 100])
def test_consecutive_and_n_in_span(spark, seed, chunk):
    rows = _random_rows(seed)
    df = _df(spark, rows)
    fail = F.col("kind") == "fail"
    got = _tuples(consecutive(df, "user", "ts", "seq", fail, 40, chunk=chunk), ["user", "first_ts", "last_ts"])
    assert got == H.consecutive(rows, "user", lambda e: e["kind"] == "fail", 2, W)
    got3 = _tuples(n_in_span(df, "user", "ts", "seq", 3, 40, chunk=chunk), ["user", "first_ts", "last_ts"])
    assert got3 == H.n_in_span(rows, "user", 3, W)
    got3f = _tuples(n_in_span(df, "user", "ts", "seq", 3, 40, cond=fail, chunk=chunk),
                    ["user", "first_ts", "last_ts"])
    assert got3f == H.n_in_span(rows, "user", 3, W, cond=lambda e: e["kind"] == "fail")


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("chunk", [None, 60])
def test_blocks_match_simulation(spark, seed, chunk):
    rows = _random_rows(seed, n=500, horizon=2500)
    got = _tuples(blocks(_df(spark, rows), "user", "ts", "seq", 4, 60, chunk=chunk), ["user", "first_ts", "last_ts"])
    assert got == H.blocks(rows, "user", 4, dt.timedelta(seconds=60))


@pytest.mark.parametrize("seed", SEEDS)
def test_threshold_then_next_matches_simulation(spark, seed):
    rows = _random_rows(seed, n=500, horizon=2000)
    got = _tuples(threshold_then_next(_df(spark, rows), "user", "ts", "seq", "value", 600, 10, chunk=10),
                  ["user", "first_ts", "next_ts"])
    assert got == H.threshold_then_next(rows, "user", "value", 600, dt.timedelta(seconds=10))


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("chunk", [None, 31])
def test_burst_matches_simulation(spark, seed, chunk):
    rows = _random_rows(seed, n=500, horizon=3000)
    got = _tuples(burst(_df(spark, rows), "user", "ts", "seq", F.col("kind") == "fail", 2, 30, chunk=chunk),
                  ["user", "first_ts", "last_ts", "times"])
    assert got == H.burst(rows, "user", lambda e: e["kind"] == "fail", 2, dt.timedelta(seconds=30))


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("chain", [False, True])
def test_follow_distinct_matches_simulation(spark, seed, chain):
    rows = _random_rows(seed, n=300, users=2, horizon=1500)
    df = _df(spark, rows)
    got = _tuples(follow_distinct(df, "user", "ts", "seq", "who", 3, 50, chain=chain, chunk=50),
                  ["user", "start_who", "first_ts", "last_ts"])
    assert got == H.follow_distinct(rows, "user", "who", 3, dt.timedelta(seconds=50), chain)


def test_follow_distinct_keyless(spark):
    rows = _random_rows(9, n=200, users=1, horizon=800)
    got = _tuples(follow_distinct(_df(spark, rows), None, "ts", "seq", "who", 4, 60, chain=False),
                  ["start_who", "first_ts", "last_ts"])
    want = [t[1:] for t in H.follow_distinct(rows, "user", "who", 4, dt.timedelta(seconds=60), False)]
    assert got == sorted(want)


def test_within_is_strict(spark):
    t0 = H.ts(0)
    exact = [(1, t0, 0, "fail", 0.0, 0), (1, t0 + dt.timedelta(seconds=5), 1, "fail", 0.0, 0)]
    inside = [(2, t0, 2, "fail", 0.0, 0), (2, t0 + dt.timedelta(seconds=5) - dt.timedelta(microseconds=1), 3,
                                            "fail", 0.0, 0)]
    df = spark.createDataFrame(exact + inside, SCHEMA)
    got = consecutive(df, "user", "ts", "seq", F.col("kind") == "fail", 5).collect()
    assert [r.user for r in got] == [2]


def test_points_fixture(spark):
    t0 = H.ts(0)
    def run(rows):
        df = spark.createDataFrame([(u, t0 + dt.timedelta(seconds=s), i, "x", float(p), 0)
                                    for i, (u, p, s) in enumerate(rows)], SCHEMA)
        return _tuples(threshold_then_next(df, "user", "ts", "seq", "value", 600, 10), ["user", "first_ts", "next_ts"])
    assert run([(1, 700, 0), (1, 10, 5)]) == [(1, t0, t0 + dt.timedelta(seconds=5))]
    assert run([(1, 600, 0), (1, 10, 5)]) == []                        # strict >
    assert run([(1, 700, 0), (1, 10, 10)]) == []                       # next at t0 + 10 s: outside
    assert len(run([(1, 700, 0), (1, 700, 1), (1, 700, 2)])) == 1      # no overlap
    assert len(run([(1, 700, 0), (2, 5, 1), (1, 10, 2)])) == 1         # other user's event does not break


def test_hot_key_split_by_chunks(spark):
    # one user holds every event; tiny chunks force many partitions with halos
    rows = [{"user": 7, "ts": H.ts(i * 3), "seq": i, "kind": "fail" if i % 5 else "ok", "value": 0.0, "who": i % 2}
            for i in range(600)]
    df = _df(spark, rows)
    got = _tuples(blocks(df, "user", "ts", "seq", 3, 10, chunk=10), ["user", "first_ts", "last_ts"])
    assert got == H.blocks(rows, "user", 3, dt.timedelta(seconds=10))
    got2 = _tuples(burst(df, "user", "ts", "seq", F.col("kind") == "fail", 2, 7, chunk=8),
                   ["user", "first_ts", "last_ts", "times"])
    assert got2 == H.burst(rows, "user", lambda e: e["kind"] == "fail", 2, dt.timedelta(seconds=7))


@pytest.mark.parametrize("seed", [5, 6, 7, 8])
def test_greedy_select_matches_sequential_rule(spark, seed):
    from clickstream.operators.sequence import greedy_select
    rnd = random.Random(seed)
    rows = []
    for key in range(3):
        for i in range(150):
            s = rnd.randrange(0, 3000) * 1_000_000
            e = s + rnd.randrange(0, 40) * 1_000_000
            rows.append((key, s, i, e, 1000 + i))
    df = spark.createDataFrame(rows, "k long, s_us long, s_seq long, e_us long, e_seq long")
    want = []
    for key in range(3):
        last = None
        for k, s, sq, e, eq in sorted((r for r in rows if r[0] == key), key=lambda r: (r[3], r[4], r[1], r[2])):
            if last is None or (s, sq) > last:
                want.append((k, s, sq))
                last = (e, eq)
    for chunk in (45, 100, None):
        got = sorted((r.k, r.s_us, r.s_seq) for r in greedy_select(df, "k", 40_000_000, chunk=chunk).collect())
        assert got == sorted(want), chunk
    keyless = greedy_select(df.where("k = 0").drop("k"), [], 40_000_000, chunk=45)
    assert sorted((0, r.s_us, r.s_seq) for r in keyless.collect()) == sorted(w for w in want if w[0] == 0)


def test_threshold_cumulative_mode(spark):
    from clickstream.operators.sequence import trailing_sum
    t0 = H.ts(0)
    rows = [(1, t0 + dt.timedelta(seconds=s), i, "x", float(p), 0)
            for i, (p, s) in enumerate([(300, 0), (200, 4), (150, 8), (10, 9), (500, 30), (5, 45)])]
    df = spark.createDataFrame(rows, SCHEMA)
    sums = {r.seq: r.trailing for r in trailing_sum(df, "user", "ts", "seq", "value", 10, chunk=10).collect()}
    assert sums == {0: 300, 1: 500, 2: 650, 3: 660, 4: 500, 5: 5}
    got = _tuples(threshold_then_next(df, "user", "ts", "seq", "value", 600, 10, mode="cumulative"),
                  ["user", "first_ts", "next_ts"])
    # seq 2 (650 over the last 10 s) then seq 3 one second later; seq 3 is consumed by that match
    assert got == [(1, t0 + dt.timedelta(seconds=8), t0 + dt.timedelta(seconds=9))]


def test_static_asset_filter(spark):
    from clickstream.functions import is_static_asset
    df = spark.createDataFrame([("/a.css",), ("/b.js",), ("/c.json",), ("/d.css/x",)], "url string")
    assert sorted(r.url for r in df.where(~is_static_asset("url")).collect()) == ["/c.json", "/d.css/x"]


def test_complete_groups_across_batches():
    import pyarrow as pa
    from clickstream.operators.sorted_groups import _complete_groups
    rows = [("a", i) for i in range(5)] + [("b", i) for i in range(7)] + [("c", 0)]
    groups = [g for g, _ in rows]
    table = pa.record_batch({"g": groups, "v": [v for _, v in rows]})
    for size in (1, 2, 3, 5, 13):
        batches = [table.slice(i, size) for i in range(0, len(rows), size)]
        parts = list(_complete_groups(iter(batches), ["g"]))
        assert pa.concat_tables(parts).to_pylist() == table.to_pylist()
        for p in parts:  # no group is split across parts
            own = p["g"].to_pylist()
            assert all(own.count(g) == groups.count(g) for g in own)


def test_greedy_select_tolerates_shared_starts(spark):
    from clickstream.operators.sequence import greedy_select
    rnd = random.Random(12)
    rows = []
    for i in range(120):
        s = rnd.randrange(0, 800) * 1_000_000
        e = s + rnd.randrange(0, 30) * 1_000_000
        rows.append((1, s, i // 2, e, 1000 + i))  # pairs of intervals share a start position
    df = spark.createDataFrame(rows, "k long, s_us long, s_seq long, e_us long, e_seq long")
    want, last = [], None
    for k, s, sq, e, eq in sorted(rows, key=lambda r: (r[3], r[4], r[1], r[2])):
        if last is None or (s, sq) > last:
            want.append((s, sq, e, eq))
            last = (e, eq)
    got = sorted((r.s_us, r.s_seq, r.e_us, r.e_seq) for r in greedy_select(df, "k", 30_000_000, chunk=35).collect())
    assert got == sorted(want)


@pytest.mark.parametrize("fan", [2, 5])
def test_greedy_select_spreads_a_key_whose_intervals_tie_all_chunks(spark, fan, monkeypatch):
    from clickstream.operators import sequence as Q
    rnd = random.Random(3)
    # a chunk is 20 s; every chunk's start lies inside some interval
    rows = [(1, s * 1_000_000, i, (s + rnd.randrange(9, 20)) * 1_000_000, 1000 + i)
            for i, s in enumerate(x for x in range(0, 1400, 2) for _ in range(rnd.randint(1, 2)))]
    rows += [(2, s * 1_000_000, s, (s + 3) * 1_000_000, s) for s in range(0, 300, 7)]
    df = spark.createDataFrame(rows, "k long, s_us long, s_seq long, e_us long, e_seq long")
    want, last = [], {}
    for k, s, sq, e, eq in sorted(rows, key=lambda r: (r[3], r[4], r[1], r[2])):
        if last.get(k) is None or (s, sq) > last[k]:
            want.append((k, s, sq))
            last[k] = (e, eq)
    levels, write = [], Q.materialize

    def seen(frame, name):
        out = write(frame, name)
        if name == "greedy-level":
            levels.append(out.groupBy("_gk", "_run").agg(F.countDistinct("_at").alias("n")).agg(F.max("n")).first()[0])
        return out

    monkeypatch.setattr(Q, "materialize", seen)
    got = sorted((r.k, r.s_us, r.s_seq) for r in Q.greedy_select(df, "k", 20_000_000, chunk=20, fan=fan).collect())
    assert got == sorted(want)
    assert levels[0] >= 65 and all(b == -(-a // fan) for a, b in zip(levels, levels[1:])) and -(-levels[-1] // fan) <= fan
