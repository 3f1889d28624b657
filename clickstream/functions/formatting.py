"""Output-time formatting (the reference prints ``yyyy/MM/dd-HH:mm:ss``)."""

from pyspark.sql import Column, functions as F

# Fixed value: the reference's display format for window bounds.
WINDOW_TIME_FORMAT = "yyyy/MM/dd-HH:mm:ss"


def format_window_time(col: str | Column, fmt: str = WINDOW_TIME_FORMAT) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, fmt)
