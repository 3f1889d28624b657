import datetime as dt

from clickstream.operators.matching import interval_join, outer_match, payment_timeout, window_join

T = dt.datetime(2024, 5, 1, 12, 0, 0)
US = dt.timedelta(microseconds=1)


def _pays(spark, rows):
    return spark.createDataFrame(rows, "tx string, pay_id long, pay_ts timestamp_ntz")


def _receipts(spark, rows):
    return spark.createDataFrame(rows, "tx string, rec_id long, rec_ts timestamp_ntz")


def test_interval_join_bounds_inclusive(spark):
    pays = _pays(spark, [("a", 1, T)])
    lo, hi = T - dt.timedelta(seconds=3), T + dt.timedelta(seconds=5)
    recs = _receipts(spark, [("a", 10, lo), ("a", 11, hi), ("a", 12, lo - US), ("a", 13, hi + US), ("b", 14, T)])
    for bucket in ("auto", None, "1 second"):
        got = sorted(r.rec_id for r in interval_join(pays, recs, "tx", "pay_ts", "rec_ts", -3, 5, bucket=bucket).collect())
        assert got == [10, 11], bucket


def test_interval_join_dense_key_each_pair_once(spark):
    pays = _pays(spark, [("u", i, T + dt.timedelta(seconds=7 * i)) for i in range(60)])
    recs = _receipts(spark, [("u", 100 + i, T + dt.timedelta(seconds=5 * i)) for i in range(80)])
    def pairs(bucket):
        return sorted((r.pay_id, r.rec_id) for r in
                      interval_join(pays, recs, "tx", "pay_ts", "rec_ts", -15, 20, bucket=bucket).collect())
    brute = sorted((p, r) for p in range(60) for r in range(100, 180)
                   if -15 <= 5 * (r - 100) - 7 * p <= 20)
    assert pairs("auto") == pairs(None) == brute


def test_outer_match_statuses(spark):
    pays = spark.createDataFrame([("m", T), ("late", T), ("p_only", T)], "tx string, ts timestamp_ntz")
    recs = spark.createDataFrame([("m", T + dt.timedelta(seconds=5)), ("late", T + dt.timedelta(seconds=6)),
                                  ("r_only", T)], "tx string, ts timestamp_ntz")
    got = sorted((r.tx, r.status) for r in outer_match(pays, recs, "tx", "ts", "ts", -3, 5).collect())
    assert got == [("late", "unmatched_left"), ("late", "unmatched_right"), ("m", "matched"),
                   ("p_only", "unmatched_left"), ("r_only", "unmatched_right")]


def test_window_join_same_window_only(spark):
    pays = _pays(spark, [("a", 1, T + dt.timedelta(seconds=14))])
    recs = _receipts(spark, [("a", 2, T + dt.timedelta(seconds=1)), ("a", 3, T + dt.timedelta(seconds=15))])
    got = [r.rec_id for r in window_join(pays, recs, "tx", "pay_ts", "rec_ts", "15 seconds").collect()]
    assert got == [2]


def test_payment_timeout(spark):
    ev = spark.createDataFrame([
        (1, 1, "create", T), (1, 2, "pay", T),                                    # same second: success
        (2, 3, "create", T), (2, 4, "pay", T + dt.timedelta(minutes=15)),         # exactly at the limit: timeout
        (3, 5, "create", T), (3, 6, "pay", T + dt.timedelta(minutes=15) - US),    # just inside: success
        (4, 7, "pay", T),                                                          # pay without create: nothing
        (5, 8, "create", T), (5, 9, "pay", T - dt.timedelta(seconds=1)),          # pay before create: timeout
    ], "order long, event_id long, kind string, ts timestamp_ntz")
    res = payment_timeout(ev.where("kind = 'create'"), ev.where("kind = 'pay'"), "order", "ts", "15 minutes")
    assert sorted(r.order for r in res.paid.collect()) == [1, 3]
    assert sorted(r.order for r in res.timed_out.collect()) == [2, 5]


def test_outer_match_repeated_keys_bucketed_equals_plain(spark):
    import random
    rnd = random.Random(4)
    pays = spark.createDataFrame([("k%d" % rnd.randrange(3), T + dt.timedelta(seconds=rnd.randrange(200)))
                                  for _ in range(120)], "tx string, ts timestamp_ntz")
    recs = spark.createDataFrame([("k%d" % rnd.randrange(4), T + dt.timedelta(seconds=rnd.randrange(200)))
                                  for _ in range(90)], "tx string, ts timestamp_ntz")
    cols = ["tx", "status", "left_ts", "right_ts"]
    plain = sorted(tuple(r[c] for c in cols) for r in outer_match(pays, recs, "tx", "ts", "ts", -3, 5).collect())
    bucketed = sorted(tuple(r[c] for c in cols) for r in
                      outer_match(pays, recs, "tx", "ts", "ts", -3, 5, unique_keys=False).collect())
    assert bucketed == plain


def test_payment_outputs_of_one_job(spark):
    rows = [(1, 1, "create", T), (1, 2, "pay", T), (2, 3, "create", T), (None, 4, "create", T), (5, 6, "create", None)]
    ev = spark.createDataFrame(rows, "order long, event_id long, kind string, ts timestamp_ntz")
    creates, pays = ev.where("kind = 'create'"), ev.where("kind = 'pay'")
    for once in (False, True):
        res = payment_timeout(creates, pays, "order", "ts", "15 minutes", write_once=once)
        assert [tuple(r) for r in res.paid.collect()] == [(1, 1, "success", T)]
        assert sorted(r.event_id for r in res.timed_out.collect()) == [3, 4, 6]
    plan = res.timed_out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PartitionFilters: [isnotnull(status" in plan  # read back, one partition each
    empty = payment_timeout(creates.where("false"), pays, "order", "ts", "15 minutes", write_once=True)
    assert empty.paid.count() == empty.timed_out.count() == 0
