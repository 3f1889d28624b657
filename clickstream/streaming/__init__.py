"""Structured Streaming twins of the batch operators.

Each twin produces, once the watermark has passed, the rows its batch operator
gives on the same data.  Event-time columns are cast to session-zone
timestamps (``withWatermark`` rejects ``timestamp_ntz``); run the session in UTC.
"""

from clickstream.streaming.windows import (
    stream_processing_time_count, stream_unique_visitors, stream_window_count, top_n_per_batch,
)
from clickstream.streaming.joins import stream_interval_join, stream_outer_match
from clickstream.streaming.stateful import (
    stream_burst, stream_consecutive, stream_one_slot_match, stream_payment_timeout, stream_quota_filter,
    stream_running_visitors, stream_sequence,
)
from clickstream.streaming.firings import firings, latest, read_versions, stream_window_changes, write_versions
from clickstream.streaming.runner import run_available, sentinel_rows, split_to_sinks

__all__ = [
    "stream_window_count", "stream_processing_time_count", "top_n_per_batch", "stream_unique_visitors",
    "stream_interval_join", "stream_outer_match", "stream_payment_timeout",
    "stream_quota_filter", "stream_consecutive", "stream_sequence", "stream_burst", "stream_running_visitors", "run_available", "sentinel_rows",
    "split_to_sinks", "stream_one_slot_match", "stream_window_changes", "write_versions", "read_versions", "latest", "firings",
]
