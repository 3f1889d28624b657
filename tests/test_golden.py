"""Golden answers on small logs typed by hand (seconds are offsets from 1558430000)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickstream.operators.matching import interval_join, one_slot_match, outer_match, payment_timeout, window_join
from clickstream.operators.quota import quota_filter
from clickstream.operators.sequence import blocks, burst, consecutive, n_in_span
from clickstream.operators.windows import window_count

BASE = 1558430000


def failed():
    return F.col("kind") == "fail"


def at(sec):
    return dt.datetime(1970, 1, 1) + dt.timedelta(seconds=BASE + sec)


def log(spark, rows):
    return spark.createDataFrame([(u, k, at(s), i) for i, (u, k, s) in enumerate(rows)],
                                 "user long, kind string, ts timestamp_ntz, seq long")


@pytest.fixture(scope="module")
def logins(spark):
    ok, no = "success", "fail"
    return log(spark, [
        (1035, no, 842), (1035, no, 843), (1035, no, 844), (1035, no, 845),
        (76456, ok, 853), (76456, ok, 857), (76456, ok, 854), (76456, no, 859), (76456, ok, 861), (76456, ok, 865),
        (8455, ok, 867), (8455, ok, 865), (8455, ok, 869), (8455, ok, 872),
        (83419, ok, 881), (83419, no, 882), (83419, ok, 885), (83419, no, 886), (83419, ok, 884), (83419, ok, 886)])


@pytest.fixture(scope="module")
def burst_log(spark):
    """780 failures of one user in one second, with a few around them."""
    return log(spark, [(1035, "fail", s) for s in (842, 843, 844, 899, 900)] + [(1035, "fail", 911)] * 780 + [(1035, "fail", 915)])


def pairs(df, last="last_ts"):
    return sorted((r.user, (r.first_ts - at(0)).seconds, (r[last] - at(0)).seconds) for r in df.collect())


def test_consecutive_and_burst(logins, burst_log):
    want = [(1035, 842, 843), (1035, 843, 844), (1035, 844, 845)]
    assert pairs(consecutive(logins, "user", "ts", "seq", failed(), "5 seconds")) == want
    assert consecutive(burst_log, "user", "ts", "seq", failed(), "5 seconds").count() == 783
    got = burst(logins, "user", "ts", "seq", failed(), 3, "2 seconds").collect()
    assert [(r.user, (r.first_ts - at(0)).seconds, (r.last_ts - at(0)).seconds, r.times) for r in got] == [(1035, 842, 844, 3)]


def test_three_in_span(logins, burst_log):
    assert pairs(n_in_span(logins, "user", "ts", "seq", 3, "5 seconds")) == sorted(
        [(1035, 842, 844), (1035, 843, 845), (8455, 865, 869), (76456, 853, 857), (76456, 857, 861),
         (83419, 881, 884), (83419, 882, 885), (83419, 884, 886), (83419, 885, 886)])
    assert n_in_span(burst_log, "user", "ts", "seq", 3, "5 seconds").count() == 780


def test_six_without_overlap(logins, burst_log):
    assert pairs(blocks(logins, "user", "ts", "seq", 6, "11 minutes")) == [(76456, 853, 865), (83419, 881, 886)]
    assert blocks(burst_log, "user", "ts", "seq", 6, "11 minutes").count() == 131


def test_order_payment(spark):
    rows = [(34729, "create", 842), (34729, "pay", 844), (34747, "create", 893), (34756, "create", 913), (34747, "pay", 893),
            (34767, "create", 949), (34768, "pay", 950), (34756, "pay", 1951), (34767, "pay", 2021)]
    ev = log(spark, rows).withColumnRenamed("seq", "event_id")
    res = payment_timeout(ev.where("kind = 'create'"), ev.where("kind = 'pay'"), "user", "ts", "15 minutes")
    assert sorted(r.user for r in res.paid.collect()) == [34729, 34747]
    assert {r.user: (r.pay_ts - at(0)).seconds for r in res.paid.collect()} == {34729: 844, 34747: 893}
    assert sorted(r.user for r in res.timed_out.collect()) == [34756, 34767]


def test_pay_and_receipt(spark):
    pays = [("sd76f87d6", 844), ("3hu3k2432", 845), ("3243hr9h9", 895), ("329d09f9f", 893), ("88snrn932", 950)]
    receipts = [("sd76f87d6", 847), ("3hu3k2432", 848), ("3243hr9h9", 892), ("329d09f9f", 893), ("8fdsfae83", 900)]
    p = spark.createDataFrame([(t, at(s), i) for i, (t, s) in enumerate(pays)], "tx string, ts timestamp_ntz, seq long")
    r = spark.createDataFrame([(t, at(s), i) for i, (t, s) in enumerate(receipts)], "tx string, rts timestamp_ntz, seq long")
    got = outer_match(p, r, "tx", "ts", "rts", -3, 5).collect()
    assert sorted(x.tx for x in got if x.status == "matched") == ["3243hr9h9", "329d09f9f", "3hu3k2432", "sd76f87d6"]
    assert sorted(x.tx for x in got if x.status != "matched") == ["88snrn932", "8fdsfae83"]
    one = one_slot_match(p, r, "tx", "ts", "rts", "seq", -3, 5).collect()
    assert sorted(x.tx for x in one if x.status == "matched") == ["3243hr9h9", "329d09f9f", "3hu3k2432", "sd76f87d6"]
    assert interval_join(p.drop("seq"), r.drop("seq"), "tx", "ts", "rts", -15, 20).count() == 4
    # windows start at multiples of 15 s of the epoch: ...895 is a start, so 892 and 895 are apart
    assert window_join(p.drop("seq"), r.drop("seq"), "tx", "ts", "rts", "15 seconds").count() == 3


def test_ad_clicks(spark):
    rows = [(937166, 1715, "beijing", i) for i in range(121)] + [(i, 1, "shanghai", i) for i in range(22)]
    clicks = spark.createDataFrame([(u, a, p, at(s), i) for i, (u, a, p, s) in enumerate(rows)],
                                   "user long, ad long, province string, ts timestamp_ntz, seq long")
    res = quota_filter(clicks, ["user", "ad"], "ts", "seq", max_count=100)
    assert res.passed.count() == 122
    assert [(r.user, r.ad) for r in res.warnings.collect()] == [(937166, 1715)]
    counts = window_count(res.passed, "ts", "1 hour", "10 seconds", keys="province")
    assert counts.agg(F.sum("cnt")).first()[0] == 122 * 360
