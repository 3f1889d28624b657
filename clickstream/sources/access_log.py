"""Web access-log lines: ``ip - user dd/MM/yyyy:HH:mm:ss zone METHOD url``.

Fields are split on single spaces; positions 0 (ip), 2 (user, ``-`` when
absent), 3 (time), 5 (method) and 6 (url) are used, the zone token is ignored
and the time is read as UTC wall clock.  Lines with too few fields or an
unparseable time are routed to ``_corrupt``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickstream.sources.schemas import CORRUPT

# Fixed value: the reference's access-log time layout.
ACCESS_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"


def format_access_line(ip: Column, user: Column, ts: Column, method: Column, url: Column) -> Column:
    """Build an access-log line; ``user`` NULL is written as ``-``."""
    return F.concat_ws(" ", ip, F.lit("-"), F.coalesce(user.cast("string"), F.lit("-")),
                       F.date_format(ts, ACCESS_TIME_FORMAT), F.lit("+0000"), method, url)


def parse_access_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """Lines -> ``ip, user_id, ts, method, url`` (+ ``_corrupt``).

    ``ts`` is ``timestamp_ntz`` (wall clock as written).
    """
    parts = F.split(F.col(col), " ")
    user = F.get(parts, 2)
    # parse in the session zone and cast back: the wall clock survives whatever the zone
    ts = F.try_to_timestamp(F.get(parts, 3), F.lit(ACCESS_TIME_FORMAT)).cast("timestamp_ntz")
    bad = (F.size(parts) < 7) | ts.isNull()
    return lines.select(
        F.get(parts, 0).alias("ip"),
        F.when(user == "-", None).otherwise(user).alias("user_id"),  # any text: logs hold names too
        ts.alias("ts"),
        F.get(parts, 5).alias("method"),
        F.get(parts, 6).alias("url"),
        F.when(bad, F.col(col)).alias(CORRUPT),
    )
