"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickstream.session import checkpoint_dir, ship_package

#: Rows and bytes of one Arrow batch sent to a Python worker.  Texts can be long, so
#: the library's operators work on small batches.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> None:
    """Session state that every operator needs: the package on the workers and small Arrow batches."""
    ship_package(spark)
    checkpoint_dir(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (compared without case)."""
    have = {c.lower() for c in df.columns}
    name = f"__{base}"
    while name.lower() in have:
        name += "_"
    return name


def text_bytes(arr: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    big = pa.types.is_large_string(arr.type)
    return arr.cast(pa.large_binary() if big else pa.binary()).to_pylist()


def by_size(items: list, most: int) -> Iterator[tuple[int, int]]:
    """Ranges ``[a, b)`` of ``items`` with at most ``most`` bytes each (one item may be larger)."""
    a, size = 0, 0
    for i, t in enumerate(items):
        n = len(t) if t is not None else 0
        if i > a and size + n > most:
            yield a, i
            a, size = i, 0
        size += n
    if a < len(items):
        yield a, len(items)


def held_out(doc_id: Column) -> Column:
    """The fold that nothing is learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def bounded_fraction(df: DataFrame, key: Column, most: int, seed: int = 7) -> Column:
    """A condition that keeps about ``most`` rows of ``df`` by a hash of ``key`` (all rows if there are fewer).

    The share is ``most / count``, so the kept number is ``most`` in expectation at any size.
    """
    n = df.count()
    if n <= most:
        return F.lit(True)
    share = int((1 << 31) * (most / n))
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 33) < F.lit(share)


def flat(chunks: Iterable[np.ndarray], dtype) -> np.ndarray:
    got = list(chunks)
    return np.concatenate(got) if got else np.empty(0, dtype)
