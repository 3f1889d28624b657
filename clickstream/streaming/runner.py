"""Running streaming twins to completion, and the end-of-input sentinel.

Spark does not flush event-time state at the end of a bounded input: windows,
joins and buffers whose watermark has not passed stay open.  A sentinel row far
in the future (in every input stream) moves the watermark past everything.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from clickstream.session import scratch_path

SENTINEL_TS = dt.datetime(2200, 1, 1)


def sentinel_rows(df: DataFrame, ts: str, **values) -> DataFrame:
    """One row with ``ts`` at :data:`SENTINEL_TS` and the given column values (others NULL)."""
    spark = df.sparkSession
    row = {f.name: values.get(f.name) for f in df.schema.fields}
    row[ts] = SENTINEL_TS
    return spark.createDataFrame([tuple(row[f.name] for f in df.schema.fields)], df.schema)


def run_available(df: DataFrame, name: str, foreach_batch=None, mode: str = "append") -> DataFrame | None:
    """Process everything available (``availableNow``) and return the result table.

    The checkpoint and the result live under the session's shared
    ``spark.checkpoint.dir``: appended rows go to a Parquet table there, unless a
    ``foreach_batch`` function is given (then its sink holds the result and None is
    returned; ``mode`` "update" needs one).  Nothing is gathered in the driver.
    """
    spark = df.sparkSession
    w = (df.writeStream.outputMode(mode)
         .option("checkpointLocation", scratch_path(spark, f"stream-{name}"))
         .trigger(availableNow=True))
    path = scratch_path(spark, f"stream-out-{name}-{uuid.uuid4().hex}")
    if foreach_batch is not None:
        q = w.foreachBatch(foreach_batch).start()
    else:
        q = w.format("parquet").option("path", path).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.schema(df.schema).parquet(path) if foreach_batch is None else None


def split_to_sinks(sinks: dict[str, Callable[[DataFrame, int], None]], col: str = "status",
                   rest: Callable[[DataFrame, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that sends each label's rows of ``col`` to its own sink.

    The named side outputs of a program: the micro-batch is computed once and kept
    while its outputs are written, so two outputs do not run the plan twice.  Rows with
    another label (NULL too) go to ``rest``; without it they stop the query before
    anything of their batch is written.
    """
    def run(batch: DataFrame, epoch_id: int) -> None:
        kept = batch.persist()
        try:
            others = kept.where(~F.coalesce(F.col(col).isin(*sinks), F.lit(False)))
            if rest is not None:
                rest(others, epoch_id)
            elif (lost := others.select(col).first()) is not None:
                raise ValueError(f"no sink for rows with {col} = {lost[0]!r}")
            for label, sink in sinks.items():
                sink(kept.where(F.col(col) == label), epoch_id)
        finally:
            kept.unpersist()
    return run
