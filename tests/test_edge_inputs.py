"""Inputs the driver's tables do not hold: NULLs, large ids, long times, hot keys, several files."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

import helpers as H
from clickstream.functions.eventtime import duration_us
from clickstream.operators.matching import interval_join, one_slot_match, outer_match, payment_timeout
from clickstream.operators.quota import quota_filter
from clickstream.operators.sequence import _exits, _ranks, blocks, burst, follow_distinct, threshold_then_next
from clickstream.operators.visitors import bitmap_visitors, running_visitors, unique_visitors
from clickstream.operators.windows import floor_div, window_agg, window_count, window_measures
from clickstream.session import drop_scratch, materialize
from clickstream.sources.access_log import parse_access_log
from clickstream.sources.files import parse_lines, read_log, split_corrupt

T = dt.datetime(2024, 5, 1, 12)
S = dt.timedelta(seconds=1)


def test_outer_match_null_keys_keep_their_side(spark):
    pays = spark.createDataFrame([(None, T), ("a", T), ("b", None)], "tx string, ts timestamp_ntz")
    recs = spark.createDataFrame([(None, T), ("a", T)], "tx string, ts timestamp_ntz")
    want = [("None", "unmatched_left"), ("None", "unmatched_right"), ("a", "matched"), ("b", "unmatched_left")]
    for unique in (True, False):
        got = outer_match(pays, recs, "tx", "ts", "ts", -3, 5, unique_keys=unique).collect()
        if unique:  # a NULL time has no bucket
            assert sorted((str(r.tx), r.status) for r in got) == want
        assert ("None", "unmatched_left") in [(str(r.tx), r.status) for r in got]


def test_interval_join_other_kinds(spark):
    pays = spark.createDataFrame([("a", T), ("z", T)], "tx string, l timestamp_ntz")
    recs = spark.createDataFrame([("a", T)], "tx string, r timestamp_ntz")
    with pytest.raises(ValueError):
        interval_join(pays, recs, "tx", "l", "r", -3, 5, how="left")
    assert interval_join(pays, recs, "tx", "l", "r", -3, 5, bucket=None, how="left").count() == 2


def test_large_ids_and_null_keys_in_sequences(spark):
    big = 2**53
    rows = [(k, T + i * S, big + i, big + i) for i in range(6) for k in (None, big, big + 1)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, seq long, who long")
    got = sorted((str(r.k), r.first_ts, r.last_ts) for r in blocks(df, "k", "ts", "seq", 3, "1 minute").collect())
    assert got == sorted((str(k), T + a * S, T + (a + 2) * S) for k in (None, big, big + 1) for a in (0, 3))
    chain = follow_distinct(df, "k", "ts", "seq", "who", 2, "1 minute", chain=True).collect()
    assert sorted(str(r.k) for r in chain) == sorted(str(k) for k in (None, big, big + 1) for _ in range(2))
    assert {r.start_who for r in chain} == {big, big + 3}


def test_null_accounts_differ_from_known_ones(spark):
    rows = [{"user": 1, "ts": T + i * S, "seq": i, "who": w} for i, w in enumerate([None, 1, None, None, 2, 1, 1, None])]
    df = spark.createDataFrame([(r["user"], r["ts"], r["seq"], r["who"]) for r in rows], "user long, ts timestamp_ntz, seq long, who long")
    for chain in (False, True):
        want = H.follow_distinct(rows, "user", "who", 2, dt.timedelta(seconds=30), chain)
        got = [(r.user, r.start_who, r.first_ts, r.last_ts) for r in
               follow_distinct(df, "user", "ts", "seq", "who", 2, 30, chain=chain).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_burst_ignores_unknown_types(spark):
    df = spark.createDataFrame([(1, T, 1, "fail"), (1, T + S, 2, None), (1, T + 2 * S, 3, "fail")], "u long, ts timestamp_ntz, seq long, kind string")
    assert burst(df, "u", "ts", "seq", F.col("kind") == "fail", 2, "1 minute").count() == 0


def test_null_times_are_in_no_window(spark):
    df = spark.createDataFrame([(1, T, 0), (2, None, 1)], "u long, ts timestamp_ntz, seq long")
    for method in ("sweep", "explode", "window"):
        assert window_count(df, "ts", "1 hour", "30 minutes", method=method).count() == 2
        assert window_count(df, "ts", "1 hour", method=method).count() == 1
    assert unique_visitors(df, "ts", "u").count() == bitmap_visitors(df, "ts", "u").count() == 1
    assert running_visitors(df, "ts", "u", "seq").count() == 1


def test_running_count_ignores_unknown_users(spark):
    df = spark.createDataFrame([(1, T, 0), (None, T + S, 1), (2, T + 2 * S, 2)], "u long, ts timestamp_ntz, seq long")
    assert sorted(r.uv_so_far for r in running_visitors(df, "ts", "u", "seq").collect()) == [1, 2]


def test_long_epoch_seconds(spark):
    base = 1_714_564_800
    df = spark.createDataFrame([(1, base + i, i, float(i)) for i in range(5)], "u long, ts long, seq long, v double")
    res = quota_filter(df, "u", "ts", "seq", max_count=3)
    assert sorted(r.seq for r in res.passed.collect()) == [0, 1, 2] and res.warnings.first().day == dt.date(2024, 5, 1)
    assert window_agg(df, "ts", "1 hour", aggs={"n": F.count_distinct("seq")}).first().n == 5
    assert window_count(df, "ts", "90 seconds", "60 seconds").agg(F.sum("cnt")).first()[0] >= 5


def test_window_measures_equal_event_copies(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice("ab"), T + rnd.randrange(3000) * S, rnd.choice([None, 1.5, 2.0, -3.25])) for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    kinds = {"s": ("sum", "v"), "c": ("count", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "m": ("avg", "v")}
    got = window_measures(df, "ts", "5 minutes", "1 minute", keys="k", measures=kinds)
    want = window_agg(df, "ts", "5 minutes", "1 minute", keys="k", aggs={
        "s": F.sum("v"), "c": F.count("v"), "lo": F.min("v"), "hi": F.max("v"), "m": F.avg("v")})
    rows = [sorted(tuple(str(round(x, 6)) if isinstance(x, float) else str(x) for x in r) for r in d.collect()) for d in (got, want)]
    assert rows[0] == rows[1]
    with pytest.raises(ValueError):
        window_measures(df, "ts", "5 minutes", "2 minutes", measures=kinds)


def test_floor_div_is_exact_for_large_values(spark):
    v = [2**60 + 7, -(2**60) - 7, -1, 0, 9_007_199_254_740_993]
    got = spark.createDataFrame([(x,) for x in v], "x long").select(floor_div(F.col("x"), 1000).alias("q")).collect()
    assert [r.q for r in got] == [x // 1000 for x in v]


def test_access_log_user_names(spark):
    line = "1.2.3.4 - alice 17/05/2015:10:05:03 +0000 GET /x"
    r = parse_access_log(spark.createDataFrame([(line,)], "value string")).first()
    assert r.user_id == "alice" and r._corrupt is None


def test_required_fields(spark):
    lines = spark.createDataFrame([("1035,,fail,1558430842",), ("1035,1.1.1.1,fail,",), (",1.1.1.1,fail,1",)], "value string")
    assert split_corrupt(parse_lines(lines, "login"))[1].count() == 3
    lines = spark.createDataFrame([("7,create,,1558430842",)], "value string")
    assert split_corrupt(parse_lines(lines, "order"))[0].count() == 1


@pytest.mark.parametrize("kind,line", [
    ("user_behavior", "1,2,3,pv,1558430842"), ("login", "1,1.1.1.1,fail,1558430842"), ("points", "1,700,sign,1558430842"),
    ("order", "1,pay,ab,1558430842"), ("receipt", "ab,wechat,1558430842"), ("ad_click", "1,2,beijing,beijing,1558430842"),
    ("marketing", "u,CLICK,mail,1558430842000")])
def test_every_log_kind(spark, kind, line):
    good, bad = split_corrupt(parse_lines(spark.createDataFrame([(line,)], "value string"), kind))
    assert good.first().event_ts == dt.datetime(2019, 5, 21, 9, 27, 22) and bad.count() == 0


def test_seq_follows_file_order(spark, tmp_path):
    for name, first in (("b.csv", 1000), ("a.csv", 0), ("c.csv", 2000)):
        (tmp_path / name).write_text("".join(f"{first + i},1.1.1.1,fail,1558430842\n" for i in range(50)))
    rows = sorted(read_log(spark, str(tmp_path), "login").collect(), key=lambda r: r.seq)
    assert [r.user_id for r in rows] == [f + i for f in (0, 1000, 2000) for i in range(50)]
    assert len({r.seq for r in rows}) == 150


def test_format_window_time(spark):
    from clickstream.functions.formatting import format_window_time
    got = spark.createDataFrame([(T,)], "t timestamp_ntz").select(format_window_time("t").alias("s")).first().s
    assert got == "2024/05/01-12:00:00"


def brute_slots(rows, lo, hi):
    """One key's events (us, is_left, seq) walked in order."""
    out, slot = [], {True: None, False: None}
    for us, left, seq in sorted(rows, key=lambda r: (r[0], not r[1], r[2])):
        for side, limit in ((True, hi), (False, -lo)):
            if slot[side] and us - slot[side][0] > limit:
                out.append(("left" if side else "right", slot[side][1]))
                slot[side] = None
        if slot[not left]:
            other = slot[not left][1]
            out.append(("matched", (seq, other) if left else (other, seq)))
            slot[not left] = None
        else:
            if slot[left]:
                out.append(("left" if left else "right", slot[left][1]))
            slot[left] = (us, seq)
    return out + [("left" if s else "right", v[1]) for s, v in slot.items() if v]


def test_one_slot_match_on_repeated_keys(spark):
    rnd = random.Random(6)
    rows = [(rnd.choice(["a", "b"]), rnd.randrange(400), i % 2 == 0, i) for i in range(160)]
    frame = lambda left: spark.createDataFrame(
        [(k, T + s * S, i) for k, s, x, i in rows if x == left] + [(None, T, 900 + left)], "tx string, ts timestamp_ntz, seq long")
    got = []
    for r in one_slot_match(frame(True), frame(False), "tx", "ts", "ts", "seq", -3, 5, left_only="left", right_only="right").collect():
        got.append((str(r.tx), r.status, (r.left_seq, r.right_seq) if r.status == "matched" else r.left_seq if r.status == "left" else r.right_seq))
    want = [(k, *x) for k in "ab" for x in brute_slots([(s, left, i) for kk, s, left, i in rows if kk == k], -3, 5)]
    assert sorted(got, key=str) == sorted(want + [("None", "left", 901), ("None", "right", 900)], key=str)


def test_cumulative_points_match_plain_sums(spark):
    rnd = random.Random(2)
    rows = [{"u": rnd.randrange(2), "ts": T + rnd.randrange(600) * S, "seq": i, "p": float(rnd.randrange(100))} for i in range(120)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "u long, ts timestamp_ntz, seq long, p double")
    for r in rows:
        r["sum"] = sum(x["p"] for x in rows if x["u"] == r["u"] and r["ts"] - 30 * S < x["ts"] <= r["ts"])
    want = H.threshold_then_next(rows, "u", "sum", 120, dt.timedelta(seconds=30))
    for chunk in (None, 40):
        got = threshold_then_next(df, "u", "ts", "seq", "p", 120, 30, mode="cumulative", chunk=chunk)
        assert sorted((r.u, r.first_ts, r.next_ts) for r in got.collect()) == want


def test_selection_work_grows_about_linearly():
    import numpy as np

    def run(n):
        rng = np.random.default_rng(1)
        s = np.sort(rng.integers(0, n, n))
        e = s + rng.integers(0, n // 2, n)
        order = np.lexsort((s, e))
        s, e = s[order], e[order]
        t = time.perf_counter()
        start, end = _ranks(s, np.arange(n), e, np.arange(n) + n)
        _exits(start, end)
        return time.perf_counter() - t

    run(20_000)
    assert run(160_000) < 40 * max(run(20_000), 0.005)


def test_hot_key_payment_is_not_quadratic(spark):
    n = 20_000  # pays first, then creates, in one span: a pair join would test n * n / 2
    pays = spark.range(n).select(F.lit(1).alias("k"), (F.lit(1_714_564_800) + F.col("id") % 400).alias("ts"), "id")
    creates = spark.range(n).select(F.lit(1).alias("k"), (F.lit(1_714_564_800) + 400 + F.col("id") % 400).alias("ts"), F.col("id").alias("event_id"))
    res = payment_timeout(creates, pays, "k", "ts", "15 minutes")
    plan = res.paid._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert res.timed_out.count() == n and res.paid.count() == 0


def test_scratch_tables_can_be_dropped(spark, tmp_path):
    df = materialize(spark.range(3), "to-drop")
    path = df.inputFiles()[0]
    assert df.count() == 3 and drop_scratch(spark) >= 1
    import os
    assert not os.path.exists(path.removeprefix("file://"))


def test_duration_parsing():
    assert duration_us("2 days") == 2 * 86_400_000_000


def test_trailing_sum_keeps_the_columns_own_values(spark):
    from clickstream.operators.sequence import trailing_sum
    nan, inf = float("nan"), float("inf")
    vals = [4e-10, 1e30, None, nan, 2.0, inf, 1.5, -3.0, 0.25]
    rows = [("u", T + 10 * i * S, i, v) for i, v in enumerate(vals)] + [(None, T, 50, 1.0), (None, T, 51, 2.0)]
    df = spark.createDataFrame(rows, "u string, ts timestamp_ntz, seq long, p double")
    got = {r.seq: r.trailing for r in trailing_sum(df, "u", "ts", "seq", "p", 15).collect()}
    want = [4e-10, 1e30, 1e30, nan, nan, inf, inf, -1.5, -2.75]
    assert str([got[i] for i in range(9)]) == str(want) and got[50] == got[51] == 3.0
    big = spark.createDataFrame([("u", T, 0, 2**62), ("u", T + S, 1, -(2**62) + 1)], "u string, ts timestamp_ntz, seq long, p long")
    assert sorted(r.trailing for r in trailing_sum(big, "u", "ts", "seq", "p", 15).collect()) == [1, 2**62]
    cents = big.select("u", "ts", "seq", F.lit("0.1").cast("decimal(20,2)").alias("p"))
    assert str(max(r.trailing for r in trailing_sum(cents, "u", "ts", "seq", "p", 15).collect())) == "0.20"


def test_quota_cuts_hot_slices_before_the_second_shuffle(spark, capsys):
    ev = spark.range(2000).select(F.lit(1).alias("u"), (F.lit(1_714_564_800) + F.col("id") % 3000).alias("ts"), "id")
    got = quota_filter(ev, "u", "ts", "id", max_count=7)
    got.passed.explain()
    plan = capsys.readouterr().out
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2
    assert sorted(r.id for r in got.passed.collect()) == list(range(7)) and got.warnings.count() == 1


def test_sink_without_a_label_is_an_error(spark):
    from clickstream.streaming.runner import split_to_sinks
    seen = []
    run = split_to_sinks({"a": lambda df, _: seen.append(df.count())})
    run(spark.createDataFrame([("a",), ("a",)], "status string"), 0)
    for other in ("b", None):
        with pytest.raises(ValueError):
            run(spark.createDataFrame([("a",), (other,)], "status string"), 1)
    assert seen == [2]


def test_scratch_folder_without_a_setting():
    from types import SimpleNamespace as N

    from clickstream.session import checkpoint_dir
    chosen = []

    def session(master, scheme):
        path = N(getFileSystem=lambda conf: N(getUri=lambda: N(getScheme=lambda: scheme)))
        jvm = N(org=N(apache=N(hadoop=N(fs=N(Path=lambda d: path)))))
        sc = N(master=master, _jvm=jvm, _jsc=N(hadoopConfiguration=lambda: None), setCheckpointDir=chosen.append)
        conf = {"spark.sql.warehouse.dir": "/w"}
        return N(conf=N(get=lambda k, *d: conf.get(k, *d)), sparkContext=sc)

    for master, scheme in (("local[4]", "file"), ("local", "file"), ("yarn", "hdfs")):
        assert checkpoint_dir(session(master, scheme)) == "/w/_scratch"
    for master in ("yarn", "spark://host:1", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            checkpoint_dir(session(master, "file"))
    assert len(chosen) == 3


@pytest.mark.parametrize("chunk", [5, 7, 60, None])
def test_one_slot_match_over_chunk_borders(spark, chunk):
    rnd = random.Random(16)
    rows = [("hot" if i % 3 else rnd.choice(["a", "b"]), rnd.randrange(700), rnd.random() < 0.5, i) for i in range(400)]
    frame = lambda left: spark.createDataFrame([(k, T + s * S, i) for k, s, x, i in rows if x == left], "tx string, ts timestamp_ntz, seq long")
    m = one_slot_match(frame(True), frame(False), "tx", "ts", "ts", "seq", -3, 5, left_only="left", right_only="right", chunk=chunk)
    got = [(r.tx, r.status, (r.left_seq, r.right_seq) if r.status == "matched" else r.left_seq if r.status == "left" else r.right_seq)
           for r in m.collect()]
    want = [(k, *x) for k in ("a", "b", "hot") for x in brute_slots([(s, left, i) for kk, s, left, i in rows if kk == k], -3, 5)]
    assert sorted(got, key=str) == sorted(want, key=str) and sum(w[1] == "matched" for w in want) > 40


def test_line_numbers_do_not_move_the_text(spark, tmp_path, capsys):
    for name, first in (("b +é%.csv", 3000), ("a.csv", 0), ("c.csv", 6000)):
        (tmp_path / name).write_text("".join(f"{first + i},1.1.1.1,fail,1558430842\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # several blocks a file, several batches a block
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        df = read_log(spark, str(tmp_path), "login")
        rows = sorted(df.collect(), key=lambda r: r.seq)
        df.explain()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r.user_id for r in rows] == list(range(9000)) and len({r.seq for r in rows}) == 9000
    assert "Exchange hashpartitioning" not in capsys.readouterr().out
