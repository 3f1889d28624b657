"""Windows that fire early, on time, and again for late rows.

A window's count is a state that changes with every micro-batch that holds rows of it.  Each
change is written as a version ``(keys, window, count, batch)``; the versions of one
micro-batch replace that batch's folder, so a micro-batch that runs twice after a failure is
there once.  From the versions come the present state (the latest per key and window) and the
kind of each firing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from clickstream.functions.eventtime import duration_us
from clickstream.streaming.windows import ET, event_time

_SPOT = ("window_start", "window_end")


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def stream_window_changes(events: DataFrame, ts: str, size, slide=None, keys=(), delay="0 seconds",
                          lateness="0 seconds", count_col: str = "cnt") -> DataFrame:
    """Counts per (keys, window) for update mode: a row whenever a count changes.

    ``keys..., window_start, window_end, <count_col>, last_ts`` (the latest event time counted).
    State is kept until the watermark (``delay``) is ``lateness`` past a window's end; later
    rows are dropped (by the watermark of the micro-batch before, so it may take one longer).
    """
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide is not None else size_us
    ntz = isinstance(events.schema[ts].dataType, T.TimestampNTZType)
    out = lambda c: c.cast("timestamp_ntz") if ntz else c
    ev = event_time(events, ts, (duration_us(delay) + duration_us(lateness)) / 1e6)
    got = (ev.groupBy(F.window(ET, f"{size_us} microseconds", f"{slide_us} microseconds").alias("_w"), *_keys(keys))
           .agg(F.count(F.lit(1)).alias(count_col), F.max(F.col(ts).cast("timestamp")).alias("last_ts")))
    return got.select(*_keys(keys), out(F.col("_w.start")).alias("window_start"), out(F.col("_w.end")).alias("window_end"),
                      count_col, out(F.col("last_ts")).alias("last_ts"))


def write_versions(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that keeps each micro-batch's changes as ``path/batch=<id>``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return run


def read_versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The written versions; ``schema`` is that of :func:`stream_window_changes`' result."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(path)


def latest(versions: DataFrame, keys=()) -> DataFrame:
    """The present state: the last version of every (keys, window)."""
    group = [*_keys(keys), *_SPOT]
    rest = [c for c in versions.columns if c not in group]
    return (versions.groupBy(*group).agg(F.max_by(F.struct(*rest), "batch").alias("_v"))
            .select(*group, *[F.col(f"_v.`{c}`") for c in rest]))


def firings(versions: DataFrame, keys=(), delay="0 seconds") -> DataFrame:
    """``versions`` with ``firing``: ``early``, ``on_time`` or ``late``.

    The watermark is the latest event time less ``delay`` and moves after each micro-batch.
    A version is ``late`` if the watermark had passed the window's end before its micro-batch;
    ``on_time`` if it is the one in force when the watermark passes; else ``early``: it was
    replaced before, or the watermark has not come that far.  A (keys, window) has at most one
    ``on_time`` version, and none if all its rows were late.
    """
    step = Window.orderBy("batch")  # one row per micro-batch
    high = F.max("last_ts").over(step.rowsBetween(Window.unboundedPreceding, 0))
    wait = F.expr(f"INTERVAL '{duration_us(delay) / 1e6:.6f}' SECOND")
    marks = (versions.groupBy("batch").agg(F.max("last_ts").alias("last_ts")).withColumn("_after", high - wait)
             .select("batch", F.lag("_after").over(step).alias("_before"), F.max("_after").over(Window.partitionBy()).alias("_final")))
    own = Window.partitionBy(*_keys(keys), *_SPOT).orderBy("batch")
    until = F.coalesce(F.lead("_before").over(own), F.when(F.lead("batch").over(own).isNull(), F.col("_final")))
    passed = lambda c: F.coalesce(c >= F.col("window_end"), F.lit(False))
    kind = (F.when(passed(F.col("_before")), "late").when(passed(F.col("_until")), "on_time").otherwise("early"))
    return (versions.join(marks, "batch").withColumn("_until", until).withColumn("firing", kind)
            .select(*versions.columns, "firing"))
