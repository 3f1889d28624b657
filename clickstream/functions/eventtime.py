"""Event-time helpers.

Internally every time computation runs on epoch microseconds (a long), which
keeps bucket arithmetic exact.  Results are turned back into the input's
timestamp type, so NTZ in gives NTZ out and LTZ in gives LTZ out.

Event times are UTC: Spark evaluates ``timestamp_ntz`` arithmetic through the
session zone, so the session must run in UTC (``build_session`` and
:func:`ensure_utc` set it), as the reference's epoch-second fields are.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

_UNITS_US = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000,
    "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}
_ABBR = {"us": "microsecond", "ms": "millisecond", "s": "second", "sec": "second",
         "min": "minute", "m": "minute", "h": "hour", "d": "day", "w": "week"}



def duration_us(d) -> int:
    """Parse ``"1 hour"``, ``"5 min"``, ``"10 s"``, ``"90 seconds"`` or a number of seconds."""
    if isinstance(d, (int, float)):
        return int(round(d * 1_000_000))
    total = 0
    parts = re.findall(r"(\d+(?:\.\d+)?)\s*([a-zA-Z]+)", d.strip())
    if not parts:
        raise ValueError(f"cannot parse duration {d!r}")
    for num, unit in parts:
        u = unit.lower()
        u = _ABBR.get(u, u.rstrip("s"))
        if u not in _UNITS_US:
            raise ValueError(f"unknown unit in duration {d!r}")
        total += int(round(float(num) * _UNITS_US[u]))
    return total


def ensure_utc(spark) -> None:
    """Pin the session time zone to UTC (event times are UTC wall clock)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def epoch_us(df: DataFrame, ts: str) -> Column:
    """Epoch microseconds of column ``ts`` (timestamp, timestamp_ntz or long seconds)."""
    dt = _dtype(df, ts)
    if isinstance(dt, T.TimestampNTZType):
        # cast through the (UTC) session zone: 2-3x cheaper than timestamp_diff
        return F.unix_micros(F.col(ts).cast("timestamp"))
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(F.col(ts))
    if isinstance(dt, (T.LongType, T.IntegerType)):
        return F.col(ts).cast("long") * F.lit(1_000_000)
    raise TypeError(f"column {ts} has no event-time type: {dt}")


def from_epoch_us(us: Column, ntz: bool = True) -> Column:
    """Inverse of :func:`epoch_us`; NTZ by default."""
    if ntz:
        return F.timestamp_micros(us).cast("timestamp_ntz")
    return F.timestamp_micros(us)


def is_ntz(df: DataFrame, ts: str) -> bool:
    return isinstance(_dtype(df, ts), T.TimestampNTZType)


def ts_is_timestamp(df: DataFrame, ts: str) -> bool:
    return isinstance(_dtype(df, ts), (T.TimestampType, T.TimestampNTZType))


def seconds_to_ts(col: str | Column) -> Column:
    """Epoch seconds (long) to an NTZ event time, as the reference's ``ts * 1000``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_seconds(c.cast("long")).cast("timestamp_ntz")


def millis_to_ts(col: str | Column) -> Column:
    """Epoch milliseconds (long) to an NTZ event time."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_millis(c.cast("long")).cast("timestamp_ntz")


def to_event_time(col: str | Column) -> Column:
    """NTZ -> session-zone timestamp, as ``withWatermark`` requires (set the session to UTC)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("timestamp")
