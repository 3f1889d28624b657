import datetime as dt

from clickstream.operators.quota import quota_filter

D = dt.datetime(2024, 3, 1, 23, 0, 0)


def test_quota_pass_drop_warn_and_daily_reset(spark):
    rows = [(1, 7, D + dt.timedelta(minutes=i), i) for i in range(5)]          # 5 clicks on day 1
    rows += [(1, 7, D + dt.timedelta(hours=2, minutes=i), 10 + i) for i in range(2)]  # day 2
    rows += [(2, 7, D, 20)]
    df = spark.createDataFrame(rows, "user long, ad long, ts timestamp_ntz, seq long")
    res = quota_filter(df, ["user", "ad"], "ts", "seq", max_count=3)
    passed = sorted(r.seq for r in res.passed.collect())
    assert passed == [0, 1, 2, 10, 11, 20]
    warns = [(r.user, r.ad, r.day, r.blocked_ts) for r in res.warnings.collect()]
    assert warns == [(1, 7, dt.date(2024, 3, 1), D + dt.timedelta(minutes=3))]


def test_quota_hot_key_keeps_order_with_ties(spark):
    # 780 identical clicks (same second): order falls back to seq
    rows = [(1035, 1, D, i) for i in range(780)]
    df = spark.createDataFrame(rows, "user long, ad long, ts timestamp_ntz, seq long")
    res = quota_filter(df, ["user", "ad"], "ts", "seq", max_count=100)
    assert sorted(r.seq for r in res.passed.collect()) == list(range(100))
    assert res.warnings.count() == 1
