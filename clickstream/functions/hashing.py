"""The bitmap position hash for approximate unique visitors.

A polynomial string hash over the decimal digits of the id, seed 61, reduced to
28 bits (a 2^28-bit bitmap, 32 MB).  Keeping only the low 28 bits after every
step equals the reference's 32-bit wrap-around followed by the final mask, so
the positions are bit-exact.  Runs as a SQL higher-order function (JVM-side).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values that must equal the reference's for identical bitmap positions.
HASH_SEED = 61
HASH_BITS = 28
HASH_MASK = (1 << HASH_BITS) - 1  # 268435455


def hash28_sql(col_sql: str) -> str:
    """SQL text of the hash; the same text runs in Spark and DuckDB."""
    return (f"aggregate(split(cast({col_sql} as string), ''), cast(0 as bigint), "
            f"(a, c) -> (a * {HASH_SEED} + ascii(c)) & {HASH_MASK})")


def hash28(col: str) -> Column:
    return F.expr(hash28_sql(f"`{col}`"))
