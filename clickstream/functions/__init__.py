from clickstream.functions.eventtime import (
    duration_us, epoch_us, from_epoch_us, seconds_to_ts, millis_to_ts, to_event_time,
)
from clickstream.functions.hashing import hash28, hash28_sql
from clickstream.functions.formatting import format_window_time
from clickstream.functions.filters import is_static_asset, not_equal_null_safe

__all__ = [
    "duration_us", "epoch_us", "from_epoch_us", "seconds_to_ts", "millis_to_ts",
    "to_event_time", "hash28", "hash28_sql", "format_window_time", "is_static_asset", "not_equal_null_safe",
]
