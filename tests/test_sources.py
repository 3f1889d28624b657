import datetime as dt

from pyspark.sql import functions as F

from clickstream.sources.access_log import format_access_line, parse_access_log
from clickstream.sources.files import parse_lines, read_log, split_corrupt


def test_order_log_csv(spark, tmp_path):
    p = tmp_path / "orders.csv"
    p.write_bytes(b"34729,create,,1558430842\r\n34729,pay,sd76f87d6,1558430844\r\nx,pay,a,1\r\n1,pay,b")
    good, bad = split_corrupt(read_log(spark, str(p), "order"))
    rows = sorted(good.collect(), key=lambda r: r.seq)
    assert [(r.order_id, r.event_type, r.tx_id) for r in rows] == [(34729, "create", None), (34729, "pay", "sd76f87d6")]
    assert rows[0].event_ts == dt.datetime(2019, 5, 21, 9, 27, 22)
    assert bad.count() == 2  # non-numeric id, short line


def test_parse_lines_routes_bad_rows(spark):
    lines = spark.createDataFrame([("1035,83.149.9.216,fail,1558430842",), ("1035,1.2.3.4,fail",),
                                   ("abc,1.2.3.4,fail,1558430842",)], "value string")
    good, bad = split_corrupt(parse_lines(lines, "login"))
    assert [(r.user_id, r.event_type) for r in good.collect()] == [(1035, "fail")]
    assert bad.count() == 2


def test_access_log_round_trip(spark):
    t = dt.datetime(2015, 5, 17, 10, 5, 3)
    df = spark.createDataFrame([("83.149.9.216", None, t), ("10.0.0.1", 42, t)], "ip string, user long, ts timestamp_ntz")
    lines = df.select(format_access_line(F.col("ip"), F.col("user"), F.col("ts"), F.lit("GET"),
                                         F.lit("/presentations/")).alias("value"))
    assert lines.first().value == "83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/"
    parsed = sorted(parse_access_log(lines).collect(), key=lambda r: r.ip)
    assert [(r.ip, r.user_id, r.ts, r.method, r.url, r._corrupt) for r in parsed] == [
        ("10.0.0.1", "42", t, "GET", "/presentations/", None),
        ("83.149.9.216", None, t, "GET", "/presentations/", None)]
    bad = parse_access_log(spark.createDataFrame([("1.2.3.4 - - notatime +0000 GET /",), ("short line",)], "value string"))
    assert bad.where("_corrupt IS NOT NULL").count() == 2


def test_marketing_log_epoch_millis(spark, tmp_path):
    p = tmp_path / "marketing.csv"
    p.write_text("u-1,CLICK,weibo,1558430842123\nu-2,UNINSTALL,tieba,1558430843000\n")
    rows = sorted(read_log(spark, str(p), "marketing").collect(), key=lambda r: r.seq)
    assert [(r.user_id, r.behavior, r.channel) for r in rows] == [("u-1", "CLICK", "weibo"), ("u-2", "UNINSTALL", "tieba")]
    assert rows[0].event_ts == dt.datetime(2019, 5, 21, 9, 27, 22, 123000)
