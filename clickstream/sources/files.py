"""Batch and streaming readers for the headerless CSV logs.

Malformed lines do not stop the job (the reference throws on the first one):
they keep their text in a ``_corrupt`` column and :func:`split_corrupt` routes
them apart.
Empty fields read as NULL (``tx_id`` on create events).  ``event_ts`` is the
NTZ event time derived from epoch seconds (or milliseconds for marketing logs).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from clickstream.functions.eventtime import millis_to_ts, seconds_to_ts
from clickstream.operators.sorted_groups import group_starts
from clickstream.sources.schemas import CORRUPT, LOG_SCHEMAS

#: Most files whose table of numbers (some 100 bytes a file) is broadcast; beyond, it is joined.
BROADCAST_FILES = 100_000
#: Fields that may be empty in a good line.
OPTIONAL = {"tx_id"}


def _finish(df: DataFrame, kind: str) -> DataFrame:
    if kind == "marketing":
        return df.withColumn("event_ts", millis_to_ts("ts_ms"))
    return df.withColumn("event_ts", seconds_to_ts("ts_s"))


def read_log(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Read a log of ``kind`` (see ``LOG_SCHEMAS``) as a batch DataFrame.

    Lines are read as text and parsed by :func:`parse_lines`, the same rule the
    socket and Kafka paths use.  Adds ``seq``: the ingest order (files by path,
    lines as they stand), used to break ties between events with equal time.  Lines are
    numbered where they are read, inside their file block; the text is not moved.
    """
    plain = lambda p: re.sub("^([a-zA-Z0-9]+):/+", r"\1:/", p)  # noqa: E731  listings and metadata write a scheme's slashes differently
    # a file's lines have numbers from the bytes of the files before it on: a block has fewer lines than bytes
    sizes = {plain(r.path): r.length for r in spark.read.format("binaryFile").load(path).select("path", "length").toLocalIterator()}
    first, at = [], 0
    for name in sorted(sizes):
        first.append((unquote(name), at))
        at += sizes[name] + 1
    files = spark.createDataFrame(first, "_path string, _base long")
    lines = spark.read.text(path).select(
        "value", F.regexp_replace("_metadata.file_path", "^([a-zA-Z0-9]+):/+", "$1:/").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"))
    numbered = lines.mapInArrow(_number_lines, lines.withColumn("_row", F.lit(0).cast("long")).schema)
    if len(first) <= BROADCAST_FILES:
        files = F.broadcast(files)
    found = numbered.withColumn("_path", F.url_decode(F.replace("_path", F.lit("+"), F.lit("%2B")))).join(files, "_path")
    return parse_lines(found.withColumn("seq", F.col("_base") + F.col("_block") + F.col("_row")), kind, keep=("seq",))


def _number_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the lines of each file block: a task reads a block's lines one after the other."""
    block, seen = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        starts = group_starts(table, ["_path", "_block"])
        row = np.arange(batch.num_rows) - np.repeat(starts, np.diff(np.append(starts, batch.num_rows)))
        name = (batch["_path"][0].as_py(), batch["_block"][0].as_py())
        if name == block:  # the block goes on from the batch before
            row[:starts[1] if len(starts) > 1 else None] += seen
        last = int(starts[-1])
        block, seen = (batch["_path"][last].as_py(), batch["_block"][last].as_py()), int(row[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(row, pa.int64())], names=[*batch.schema.names, "_row"])


def read_log_stream(spark: SparkSession, path: str, kind: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming twin of :func:`read_log` over a folder of log files."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_lines(r.text(path), kind)


def parse_lines(lines: DataFrame, kind: str, col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse comma-separated text lines (socket / Kafka values) into a log schema.

    Lines with a wrong field count, an uncastable field or an empty field (only
    ``tx_id`` may be empty) keep their text in ``_corrupt``; ``try_cast`` keeps
    ANSI mode from failing the job.  Columns in ``keep`` stay.
    """
    schema = LOG_SCHEMAS[kind]
    parts = F.split(F.col(col), ",")
    cols, bad = [], F.size(parts) != len(schema.fields)
    for i, f in enumerate(schema.fields):
        raw = F.trim(F.get(parts, i))
        raw = F.when(raw == "", None).otherwise(raw)
        v = raw.try_cast(f.dataType) if not isinstance(f.dataType, T.StringType) else raw
        bad = bad | ((raw.isNotNull() if f.name in OPTIONAL else F.lit(True)) & v.isNull())
        cols.append(v.alias(f.name))
    out = lines.select(*cols, F.when(bad, F.col(col)).alias(CORRUPT), *keep)
    return _finish(out, kind)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the ``_corrupt`` column, corrupt rows)."""
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = df.where(F.col(CORRUPT).isNotNull())
    return good, bad


def read_kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """Kafka lines as a streaming ``value`` string column (connector jar needed at run time)."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting).load()
            .select(F.col("value").cast("string").alias("value")))


def read_socket_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Socket lines (development only; tests use the file source)."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()
