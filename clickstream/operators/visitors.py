"""Unique visitors per tumbling window: exact, bitmap-approximate and running.

* :func:`unique_visitors` - exact distinct users per window (two-level
  aggregation: partial ``(window, user)`` dedup map-side, then count).
* :func:`bitmap_visitors` - distinct 28-bit hash positions per window, i.e. the
  population count of the reference's 2^28-bit bitmap.  Built on Spark's
  ``bitmap_*`` aggregates: positions are grouped into 32 768-bit chunks, each
  chunk's bitmap is OR-merged map-side (partial aggregation), so the shuffle
  carries at most 8 192 4-KB chunks per window instead of one row per visit.
* :func:`running_visitors` - the reference's per-event trigger: one row each time
  a window sees a new hash position, with the count so far.  The "so far" count
  is a prefix count over first visits; it is split by sub-window slices so a hot
  window is ranked by many tasks (slice totals are tiny and carried in).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from clickstream.functions.eventtime import duration_us, epoch_us, from_epoch_us, is_ntz
from clickstream.functions.hashing import hash28
from clickstream.operators.windows import floor_div


def _bucket(df: DataFrame, ts: str, size_us: int):
    """Tumbling window number of ``ts`` (window end = (bucket + 1) * size)."""
    return floor_div(epoch_us(df, ts), size_us)


def _ends(size_us: int, ntz: bool, b: str = "_b"):
    end_us = (F.col(b) + 1) * F.lit(size_us)
    return [from_epoch_us(end_us - F.lit(size_us), ntz).alias("window_start"),
            from_epoch_us(end_us, ntz).alias("window_end")]


def unique_visitors(df: DataFrame, ts: str, user: str, size="1 hour", out: str = "uv") -> DataFrame:
    """Exact distinct ``user`` per tumbling window -> ``window_start, window_end, uv``."""
    size_us = duration_us(size)
    ntz = is_ntz(df, ts)
    return (df.where(F.col(ts).isNotNull()).select(_bucket(df, ts, size_us).alias("_b"), F.col(user).alias("_u"))
            .groupBy("_b").agg(F.count_distinct("_u").alias(out))
            .select(*_ends(size_us, ntz), F.col(out).cast("long").alias(out)))


def bitmap_visitors(df: DataFrame, ts: str, user: str, size="1 hour", out: str = "uv") -> DataFrame:
    """Set bits of the hash28 bitmap per tumbling window -> ``window_start, window_end, uv``."""
    size_us = duration_us(size)
    ntz = is_ntz(df, ts)
    pos = df.where(F.col(ts).isNotNull()).select(_bucket(df, ts, size_us).alias("_b"), hash28(user).alias("_h"))
    chunks = (pos.groupBy("_b", F.bitmap_bucket_number("_h").alias("_chunk"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_h")).alias("_bm")))
    return (chunks.groupBy("_b").agg(F.sum(F.bitmap_count("_bm")).alias(out))
            .select(*_ends(size_us, ntz), F.col(out).cast("long").alias(out)))


def running_visitors(df: DataFrame, ts: str, user: str, seq: str, size="1 hour",
                     slice_="1 minute", out: str = "uv_so_far") -> DataFrame:
    """One row per first visit of a hash position in a window, with the running count.

    Returns ``window_end, <user>, uv_so_far``.  Order within a window is
    ``(ts, seq)``; a repeat visitor (same hash position) emits nothing.
    """
    size_us, slice_us = duration_us(size), duration_us(slice_)
    ntz = is_ntz(df, ts)
    us = epoch_us(df, ts)
    # first visit per (window, position): a min over a struct, aggregated map-side
    known = df.where(F.col(ts).isNotNull() & F.col(user).isNotNull())  # no user is no visitor, as in unique_visitors
    firsts = (known.select(floor_div(us, size_us).alias("_b"), hash28(user).alias("_h"),
                        F.struct(us.alias("us"), F.col(seq).alias("seq"), F.col(user).alias("u")).alias("_f"))
              .groupBy("_b", "_h").agg(F.min("_f").alias("_f"))
              .select("_b", F.col("_f.us").alias("_us"), F.col("_f.seq").alias("_seq"),
                      F.col("_f.u").alias(user))
              .withColumn("_s", floor_div(F.col("_us"), slice_us)))
    # first visits per slice, and how many came in earlier slices of the same window
    per_slice = firsts.groupBy("_b", "_s").agg(F.count(F.lit(1)).alias("_n"))
    carry = per_slice.select(
        "_b", "_s",
        (F.sum("_n").over(Window.partitionBy("_b").orderBy("_s")) - F.col("_n")).alias("_carry"))
    in_slice = Window.partitionBy("_b", "_s").orderBy("_us", "_seq")
    ranked = firsts.join(carry, ["_b", "_s"]).select(
        "_b", user, (F.col("_carry") + F.row_number().over(in_slice)).alias(out))
    end_us = (F.col("_b") + 1) * F.lit(size_us)
    return ranked.select(from_epoch_us(end_us, ntz).alias("window_end"), user,
                         F.col(out).cast("long").alias(out))
