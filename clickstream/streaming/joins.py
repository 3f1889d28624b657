"""Stream-stream joins with watermarks: interval and outer match.

Spark keeps each side's rows in state until the other side's watermark proves
no partner can still arrive, then drops them (and, for outer joins, emits the
unmatched row).  The time bounds in the join condition are what lets it do so.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, functions as F

from clickstream.functions.eventtime import duration_us
from clickstream.operators.matching import _signed_us


def _iv(us: int):
    """A day-time interval literal (keeps join/window bounds visible to the watermark logic)."""
    return F.lit(_dt.timedelta(microseconds=us))


def _wm(df: DataFrame, ts: str, name: str, delay) -> DataFrame:
    return df.withColumn(name, F.col(ts).cast("timestamp")).withWatermark(name, f"{duration_us(delay)} microseconds")


def _band(l: str, r: str, lo_us: int, hi_us: int):
    return ((F.col(r) >= F.col(l) + _iv(lo_us))
            & (F.col(r) <= F.col(l) + _iv(hi_us)))


def stream_interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                         lower, upper, delay="0 seconds") -> DataFrame:
    """Twin of ``interval_join``: equal keys, ``right.ts in [left.ts + lower, left.ts + upper]``."""
    l = _wm(left.withColumnRenamed(key, "_lk"), left_ts, "_let", delay)
    r = _wm(right.withColumnRenamed(key, "_rk"), right_ts, "_ret", delay)
    cond = (F.col("_lk") == F.col("_rk")) & _band("_let", "_ret", _signed_us(lower), _signed_us(upper))
    return l.join(r, cond, "inner").withColumnRenamed("_lk", key).drop("_rk", "_let", "_ret")


def stream_outer_match(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                       lower, upper, delay="0 seconds", matched: str = "matched",
                       left_only: str = "unmatched_left", right_only: str = "unmatched_right") -> DataFrame:
    """Twin of ``outer_match``: full outer equi + band join with a status column."""
    l = _wm(left.select(F.col(key).alias("_lk"), F.col(left_ts).alias("left_ts"), F.lit(True).alias("_is_l")), "left_ts", "_let", delay)
    r = _wm(right.select(F.col(key).alias("_rk"), F.col(right_ts).alias("right_ts"), F.lit(True).alias("_is_r")), "right_ts", "_ret", delay)
    cond = (F.col("_lk") == F.col("_rk")) & _band("_let", "_ret", _signed_us(lower), _signed_us(upper))
    j = l.join(r, cond, "fullOuter")
    status = (F.when(F.col("_is_l").isNotNull() & F.col("_is_r").isNotNull(), F.lit(matched))
              .when(F.col("_is_l").isNotNull(), F.lit(left_only)).otherwise(F.lit(right_only)))
    return j.select(F.coalesce("_lk", "_rk").alias(key), status.alias("status"), "left_ts", "right_ts")
