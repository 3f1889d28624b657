"""Per-key daily quota with a blacklist output.

Per (keys, UTC event day) the first ``max_count`` rows in ``(ts, seq)`` order
pass; later rows are dropped; the first dropped row yields one warning.  The
reference resets counters at processing-time midnight; here the day is the
event's date, so replays give the same answer.

Plan, the same for every ``max_count``: rows are numbered per (keys, day, time slice) and
cut at ``max_count + 1``, then what is left is numbered per (keys, day) and cut again.
The input is read once and nothing is joined.  A hot key (one clicking bot) is spread
over its slices, and the second numbering gets at most ``max_count + 1`` rows of each.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window, functions as F

from clickstream.functions.eventtime import duration_us, epoch_us
from clickstream.operators.windows import floor_div

_DAY_US = 86_400_000_000


class QuotaResult(NamedTuple):
    passed: DataFrame     # input rows within the quota, plus ``day``
    warnings: DataFrame   # one row per (keys, day) over quota: keys, day, blocked_ts, msg


def quota_filter(df: DataFrame, keys, ts: str, seq: str, max_count: int = 100,
                 day_col: str = "day", slice_="5 minutes") -> QuotaResult:
    """Rows within the quota, and a warning per (keys, day) over it.

    ``ts`` is a timestamp or a long of epoch seconds.  Rows without a time belong to
    no day and are in neither output; NULL keys are a key like any other.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    slice_us = duration_us(slice_)
    us = epoch_us(df, ts)
    rows = df.where(F.col(ts).isNotNull()).select(
        F.struct("*").alias("_row"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        us.alias("_us"), F.col(seq).alias("_seq"),
        floor_div(us, _DAY_US).alias("_day"), floor_div(us, slice_us).alias("_slice"))
    group = [f"_k{i}" for i in range(len(keys))] + ["_day"]
    order = ["_us", "_seq"]
    # a plain comparison would get a limit before the shuffle for small quotas only: one plan for all
    plain_rn = lambda c: F.greatest(F.col(c), F.lit(1))
    early = (rows.withColumn("_n", F.row_number().over(Window.partitionBy(*group, "_slice").orderBy(*order)))
             .where(plain_rn("_n") <= max_count + 1))
    ranked = (early.withColumn("_rn", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
              .where(plain_rn("_rn") <= max_count + 1)
              .withColumn("_date", F.date_add(F.lit("1970-01-01").cast("date"), F.col("_day").cast("int"))))
    plain = [F.col(f"_row.`{c}`") for c in df.columns if c != day_col]
    passed = ranked.where(plain_rn("_rn") <= max_count).select(*plain, F.col("_date").alias(day_col))
    warnings = ranked.where(plain_rn("_rn") == max_count + 1).select(
        *[F.col(f"_row.`{k}`") for k in keys], F.col("_date").alias(day_col), F.col(f"_row.`{ts}`").alias("blocked_ts"),
        F.lit(f"over {max_count} per day").alias("msg"))
    return QuotaResult(passed, warnings)
