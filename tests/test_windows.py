import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clickstream.operators.windows import top_n, window_count
from helpers import T0, sliding_counts, ts

EPOCH = dt.datetime(1970, 1, 1)


def _events(spark, rows):
    return spark.createDataFrame([(r["k"], r["ts"], r["seq"]) for r in rows], "k string, ts timestamp_ntz, seq long")


def _as_dict(df, key="k"):
    return {(r[key], int((r["window_end"] - EPOCH).total_seconds())): r["cnt"] for r in df.collect()}


@pytest.mark.parametrize("size,slide", [(60, 10), (3600, 300), (50, 50), (40, 8)])
def test_sweep_equals_explode_equals_window_equals_brute(spark, size, slide):
    rnd = random.Random(size * 7 + slide)
    rows = [{"k": rnd.choice("abc"), "ts": ts(rnd.randrange(0, 2000)), "seq": i} for i in range(300)]
    df = _events(spark, rows)
    want = sliding_counts(rows, "k", size, slide)
    for method in ("sweep", "explode", "window"):
        got = _as_dict(window_count(df, "ts", size, slide, keys=["k"], method=method, chunk_slides=7))
        assert got == want, method


def test_small_chunks_keyless(spark):
    rnd = random.Random(3)
    rows = [{"k": "x", "ts": ts(rnd.randrange(0, 5000)), "seq": i} for i in range(400)]
    df = _events(spark, rows).drop("k")
    want = {e: c for (_, e), c in sliding_counts(rows, "k", 600, 30).items()}
    for chunk in (20, 21, 64, None):
        got = {int((r["window_end"] - EPOCH).total_seconds()): r["cnt"]
               for r in window_count(df, "ts", 600, 30, chunk_slides=chunk).collect()}
        assert got == want, chunk


def test_event_at_window_end_belongs_to_next(spark):
    # 10:00:00 exactly is the end of [9:00, 10:00) and the start of [10:00, 11:00)
    t = dt.datetime(2024, 1, 1, 10, 0, 0)
    df = spark.createDataFrame([(t,)], "ts timestamp_ntz")
    rows = window_count(df, "ts", "1 hour").collect()
    assert [(r.window_start, r.window_end, r.cnt) for r in rows] == [(t, t + dt.timedelta(hours=1), 1)]
    just_before = t - dt.timedelta(microseconds=1)
    df2 = spark.createDataFrame([(just_before,)], "ts timestamp_ntz")
    assert window_count(df2, "ts", "1 hour").first().window_end == t


def test_output_types_follow_input(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 5),)], "ts timestamp_ntz")
    out = window_count(df, "ts", "1 minute", "10 seconds")
    assert dict(out.dtypes) == {"window_start": "timestamp_ntz", "window_end": "timestamp_ntz", "cnt": "bigint"}
    ltz = df.select(F.col("ts").cast("timestamp").alias("ts"))
    out2 = window_count(ltz, "ts", "1 minute", "10 seconds")
    assert dict(out2.dtypes)["window_end"] == "timestamp"
    assert out2.count() == 6


def test_top_n_ties_by_key_and_short_groups(spark):
    w1, w2 = T0, T0 + dt.timedelta(hours=1)
    df = spark.createDataFrame(
        [(w1, "b", 5), (w1, "a", 5), (w1, "c", 7), (w1, "d", 1), (w2, "z", 2)],
        "window_end timestamp_ntz, item string, cnt long")
    got = sorted((r.window_end, r.rank, r.item) for r in top_n(df, 3, key="item").collect())
    assert got == [(w1, 1, "c"), (w1, 2, "a"), (w1, 3, "b"), (w2, 1, "z")]


def test_top_n_plan_limits_before_shuffle(spark, capsys):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), F.col("id").alias("item"),
                                  (F.col("id") % 13).alias("cnt"))
    top_n(df, 3, by="g", key="item").explain()
    plan = capsys.readouterr().out
    # partial limit under the exchange, final limit above it
    assert plan.count("WindowGroupLimit") == 2


def test_window_agg_matches_window_count_and_sums(spark):
    from clickstream.operators.windows import window_agg
    rnd = random.Random(21)
    rows = [(rnd.choice("ab"), ts(rnd.randrange(0, 500)), float(rnd.randrange(10))) for _ in range(200)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    agg = window_agg(df, "ts", 60, 20, keys="k", aggs={"cnt": F.count("*"), "total": F.sum("v"),
                                                        "top": F.max("v")})
    counts = {(r.k, r.window_end): r.cnt for r in window_count(df, "ts", 60, 20, keys="k").collect()}
    got = {(r.k, r.window_end): r.cnt for r in agg.collect()}
    assert got == counts
    for r in agg.collect():
        members = [v for k, t, v in rows if k == r.k and r.window_start <= t < r.window_end]
        assert r.total == sum(members) and r.top == max(members)


def test_window_top_n_equals_count_then_rank(spark):
    from clickstream.operators.windows import window_top_n
    rnd = random.Random(8)
    rows = [{"k": rnd.choice("abcdefg"), "ts": ts(rnd.randrange(0, 1500)), "seq": i} for i in range(400)]
    df = _events(spark, rows)
    cols = ["k", "window_start", "window_end", "cnt", "rank"]
    fused = sorted(tuple(r[c] for c in cols) for r in window_top_n(df, "ts", 120, 10, keys="k", n=2).collect())
    plain = sorted(tuple(r[c] for c in cols) for r in
                   top_n(window_count(df, "ts", 120, 10, keys="k"), 2, key="k").collect())
    assert fused == plain
    odd = window_top_n(df, "ts", 25, 10, keys="k", n=2)  # size not a multiple of slide
    assert odd.count() == top_n(window_count(df, "ts", 25, 10, keys="k"), 2, key="k").count()


@pytest.mark.parametrize("chunk", [12, 13, 40, None])
def test_sliding_distinct_users_match_brute_force(spark, chunk):
    from clickstream.operators.windows import window_unique
    rnd = random.Random(31)
    rows = [{"k": rnd.choice(["a", "b", None]), "ts": ts(rnd.randrange(0, 3000) + rnd.random()), "u": rnd.choice([1, 1, 1, 2, 3, None])}
            for _ in range(250)]
    df = spark.createDataFrame([(r["k"], r["ts"], r["u"]) for r in rows] + [("a", None, 9)], "k string, ts timestamp_ntz, u long")
    want = {}
    for r in rows:
        if r["u"] is not None:
            t = (r["ts"] - EPOCH).total_seconds()
            for e in range(int(t // 30) + 1, int(t // 30) + 13):
                want.setdefault((r["k"], e * 30), set()).add(r["u"])
    got = {(r.k, int((r.window_end - EPOCH).total_seconds())): r.uv
           for r in window_unique(df, "ts", "u", 360, 30, keys="k", chunk_slides=chunk).collect()}
    assert got == {k: len(v) for k, v in want.items()}
    keyless = window_unique(df, "ts", "u", 360, 30, chunk_slides=chunk).agg(F.sum("uv")).first()[0]
    assert keyless == sum(len(set().union(*(v for (k, e), v in want.items() if e == end))) for end in {e for _, e in want})


def test_sliding_measures_do_not_copy_buckets_into_windows(spark, capsys):
    from clickstream.operators.windows import window_agg, window_measures
    rnd = random.Random(5)
    nan = float("nan")
    rows = [(rnd.choice(["a", "b", None]), ts(rnd.randrange(0, 6000)), rnd.choice([None, nan, 1e30, 0.5, -2.0])) for _ in range(150)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    kinds = {"s": ("sum", "v"), "c": ("count", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "m": ("avg", "v")}
    for size, slide in ((600, 30), (90, 90), (60, 20)):
        got = window_measures(df, "ts", size, slide, keys="k", measures=kinds)
        want = window_agg(df, "ts", size, slide, keys="k", aggs={
            "s": F.sum("v"), "c": F.count("v"), "lo": F.min("v"), "hi": F.max("v"), "m": F.avg("v")})
        text = [sorted(tuple(f"{x:.9g}" if isinstance(x, float) else str(x) for x in r) for r in d.collect()) for d in (got, want)]
        assert text[0] == text[1], (size, slide)
    keyless = window_measures(df, "ts", 600, 30, measures={"c": ("count", "v")}).agg(F.sum("c")).first()[0]
    assert keyless == 20 * sum(v is not None for *_, v in rows)


def test_segments_rank_fewer_rows_than_windows(spark):
    from clickstream.operators.windows import _deltas, _intervals, bucketed, window_top_n
    rnd = random.Random(9)
    rows = [{"k": rnd.choice("abcdefghij"), "ts": ts(rnd.randrange(0, 40_000)), "seq": i} for i in range(300)]
    df = _events(spark, rows)
    cols = ["k", "window_end", "cnt", "rank"]
    for chunk in (130, 200, None):
        got = sorted(tuple(r[c] for c in cols) for r in window_top_n(df, "ts", 600, 5, keys="k", n=2, chunk_slides=chunk).collect())
        want = sorted(tuple(r[c] for c in cols) for r in top_n(window_count(df, "ts", 600, 5, keys="k"), 2, key="k").collect())
        assert got == want, chunk
    counts = bucketed(df, "ts", 5_000_000, ["k"]).groupBy("k", "_b").agg(F.count("*").alias("_c"))
    points = _deltas(_intervals(counts, 120), ["k"], 4096).select("_k", "e").distinct().count()
    assert points < 0.1 * 40_600 / 5  # segments, against window ends of the time line
