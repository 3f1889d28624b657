"""Row predicates shared by the catalogue and users."""

from pyspark.sql import Column, functions as F

# Fixed value: the reference's (disabled) static-asset pattern, as a suffix test.
STATIC_ASSET_SUFFIX = r"\.(css|js)$"


def is_static_asset(url: str | Column) -> Column:
    """True for URLs ending in ``.css`` or ``.js`` (the reference's optional exclusion)."""
    c = F.col(url) if isinstance(url, str) else url
    return c.rlike(STATIC_ASSET_SUFFIX)


def not_equal_null_safe(col: str | Column, value) -> Column:
    """``col != value`` that keeps NULL rows (the reference compares strings in Scala)."""
    c = F.col(col) if isinstance(col, str) else col
    return ~c.eqNullSafe(F.lit(value))
