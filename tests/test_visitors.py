import datetime as dt

from pyspark.sql import functions as F

from clickstream.functions.hashing import hash28
from clickstream.operators.visitors import bitmap_visitors, running_visitors, unique_visitors

T = dt.datetime(2024, 1, 1, 5, 0, 0)


def test_hash28_fixed_value(spark):
    assert spark.range(1).select(hash28_col(spark)).first()[0] == 153117343


def hash28_col(spark):
    return F.expr("aggregate(split(cast(12345 as string), ''), cast(0 as bigint), (a, c) -> (a * 61 + ascii(c)) & 268435455)")


def test_hash28_column(spark):
    df = spark.createDataFrame([(12345,)], "u long")
    assert df.select(hash28("u")).first()[0] == 153117343


def test_running_uv_skips_repeats(spark):
    rows = [("a", T, 1), ("b", T + dt.timedelta(minutes=1), 2), ("a", T + dt.timedelta(minutes=2), 3),
            ("c", T + dt.timedelta(minutes=3), 4)]
    df = spark.createDataFrame(rows, "user string, ts timestamp_ntz, seq long")
    got = sorted((r.user, r.uv_so_far) for r in running_visitors(df, "ts", "user", "seq", "1 hour").collect())
    assert got == [("a", 1), ("b", 2), ("c", 3)]


def test_running_uv_across_slices(spark):
    # many slices in one hour: the carried count must continue across slices
    rows = [(f"u{i}", T + dt.timedelta(seconds=37 * i), i) for i in range(90)]
    df = spark.createDataFrame(rows, "user string, ts timestamp_ntz, seq long")
    got = sorted(r.uv_so_far for r in running_visitors(df, "ts", "user", "seq", "1 hour", slice_="10 seconds").collect())
    assert got == list(range(1, 91))


def test_exact_and_bitmap_agree_without_collisions(spark):
    rows = [(u, T + dt.timedelta(minutes=m), 0) for u in range(50) for m in (0, 30, 70)]
    df = spark.createDataFrame(rows, "user long, ts timestamp_ntz, seq long")
    exact = {r.window_end: r.uv for r in unique_visitors(df, "ts", "user").collect()}
    bitmap = {r.window_end: r.uv for r in bitmap_visitors(df, "ts", "user").collect()}
    assert exact == bitmap == {T + dt.timedelta(hours=1): 50, T + dt.timedelta(hours=2): 50}
