"""clickstream: user-behaviour analytics operators for PySpark.

Every operator takes DataFrames and returns DataFrames.  The batch form is the
definition of the result ("all data present, ordered by event time, ties by an
ingest sequence column"); the streaming twins in :mod:`clickstream.streaming`
produce the same rows once the watermark has passed.
"""

from clickstream.session import build_session, checkpoint_dir, drop_scratch, ship_package
from clickstream.operators.windows import top_n, window_agg, window_count, window_measures, window_top_n, window_unique
from clickstream.operators.visitors import bitmap_visitors, running_visitors, unique_visitors
from clickstream.operators.quota import quota_filter
from clickstream.operators.sequence import (
    blocks, burst, consecutive, follow_distinct, greedy_select, n_in_span, threshold_then_next, trailing_sum,
)
from clickstream.operators.pattern import Step, match_sequence
from clickstream.operators.matching import interval_join, one_slot_match, outer_match, payment_timeout, window_join
from clickstream.operators.sorted_groups import scan_sorted_groups

__all__ = [
    "build_session", "checkpoint_dir", "ship_package",
    "window_count", "window_top_n", "window_agg", "window_measures", "window_unique", "top_n",
    "unique_visitors", "bitmap_visitors", "running_visitors",
    "quota_filter",
    "consecutive", "n_in_span", "blocks", "threshold_then_next", "trailing_sum", "burst", "follow_distinct",
    "greedy_select", "Step", "match_sequence",
    "interval_join", "outer_match", "window_join", "payment_timeout", "one_slot_match", "scan_sorted_groups", "drop_scratch",
]
