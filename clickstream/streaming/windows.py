"""Streaming window counts, Top-N and unique visitors."""

from __future__ import annotations

import datetime as _dt

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F, types as T

from clickstream.functions.eventtime import duration_us
from clickstream.operators.windows import top_n

ET = "_et"


def _iv(us: int):
    """A day-time interval literal (keeps join/window bounds visible to the watermark logic)."""
    return F.lit(_dt.timedelta(microseconds=us))


def event_time(df: DataFrame, ts: str, delay) -> DataFrame:
    """Add the watermarked event-time column ``_et`` (a session-zone timestamp)."""
    c = F.col(ts)
    if isinstance(df.schema[ts].dataType, (T.LongType, T.IntegerType)):
        c = F.timestamp_seconds(c)
    return df.withColumn(ET, c.cast("timestamp")).withWatermark(ET, f"{duration_us(delay)} microseconds")


def _out_ts(c, ntz: bool):
    return c.cast("timestamp_ntz") if ntz else c


def stream_window_count(events: DataFrame, ts: str, size, slide=None, keys=(), delay="0 seconds",
                        count_col: str = "cnt", lateness="0 seconds") -> DataFrame:
    """Append-mode twin of :func:`clickstream.operators.windows.window_count`.

    Counts per slide-wide tumbling bucket first (one state row per key and
    bucket), then re-windows the bucket counts into the sliding windows, so the
    ``size / slide`` expansion applies to buckets, not events.  A window is
    emitted once, when the watermark passes its end.  ``lateness`` (the
    reference's allowed lateness) is added to the watermark delay: late rows
    still count, and each window is emitted once, complete.
    """
    delay = duration_us(delay) / 1e6 + duration_us(lateness) / 1e6
    keys = [keys] if isinstance(keys, str) else list(keys)
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide is not None else size_us
    ntz = isinstance(events.schema[ts].dataType, T.TimestampNTZType)
    ev = event_time(events, ts, delay)
    pre = ev.groupBy(F.window(ET, f"{slide_us} microseconds").alias("_w1"), *keys).agg(
        F.count(F.lit(1)).alias("_c"))
    if size_us == slide_us:
        win, agg = "_w1", F.col("_c")
        out = pre
    else:
        out = pre.groupBy(F.window(F.window_time("_w1"), f"{size_us} microseconds", f"{slide_us} microseconds")
                          .alias("_w"), *keys).agg(F.sum("_c").alias("_c"))
        win = "_w"
    return out.select(*keys, _out_ts(F.col(f"{win}.start"), ntz).alias("window_start"),
                      _out_ts(F.col(f"{win}.end"), ntz).alias("window_end"),
                      F.col("_c").cast("long").alias(count_col))


def stream_processing_time_count(events: DataFrame, size, slide=None, keys=(), count_col: str = "cnt",
                                 ingest_col: str = "ingest_ts") -> DataFrame:
    """Processing-time windows (the reference's hot-sale program): each row is
    stamped with its ingest time and windowed on it with a zero delay, so a
    window is emitted as soon as the clock has passed its end."""
    stamped = events.withColumn(ingest_col, F.current_timestamp())
    return stream_window_count(stamped, ingest_col, size, slide, keys, delay="0 seconds", count_col=count_col)


def top_n_per_batch(n: int, sink: Callable[[DataFrame, int], None], by: str = "window_end",
                    key: str | None = None, count_col: str = "cnt") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function ranking the windows each micro-batch completes.

    In append mode a window's counts for every key are emitted together, in the
    micro-batch where the watermark passes the window end, so ranking inside
    the micro-batch is exact and uses the batch plan (partial group limit).
    """
    def run(batch: DataFrame, epoch_id: int) -> None:
        sink(top_n(batch, n, by=by, key=key, count_col=count_col), epoch_id)
    return run


def stream_unique_visitors(events: DataFrame, ts: str, user: str, size="1 hour", delay="0 seconds",
                           out: str = "uv") -> DataFrame:
    """Exact distinct users per tumbling window, in append mode.

    Distinct aggregations are not supported on streams, so each (window, user)
    is first deduplicated.  The watermark is put on the window *end*, which is
    in the dedup key, so dedup state is dropped when the window closes; the
    delay on it is ``size + delay`` so no event within the raw delay is lost.
    """
    size_us, delay_us = duration_us(size), duration_us(delay)
    ntz = isinstance(events.schema[ts].dataType, T.TimestampNTZType)
    ev = events.withColumn("_wend", F.window(F.col(ts).cast("timestamp"), f"{size_us} microseconds").end)
    ev = ev.withWatermark("_wend", f"{size_us + delay_us} microseconds")
    firsts = ev.dropDuplicates(["_wend", user])
    counts = firsts.groupBy("_wend").agg(F.count(F.lit(1)).alias(out))
    return counts.select(_out_ts(F.col("_wend") - _iv(size_us), ntz)
                         .alias("window_start"),
                         _out_ts(F.col("_wend"), ntz).alias("window_end"), F.col(out).cast("long").alias(out))
