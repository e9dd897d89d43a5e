"""Calendar parts and local time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the marts report local time in this zone.
DEFAULT_TIME_ZONE = "Australia/Sydney"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_of(ts) -> Column:
    """Month number 1-12 (no year: the same month of two years merges)."""
    return F.month(_c(ts))


def iso_week_of(ts) -> Column:
    """ISO-8601 week number (2022-01-01 is week 52)."""
    return F.weekofyear(_c(ts))


def local_time(ts, tz: str = DEFAULT_TIME_ZONE) -> Column:
    """UTC timestamp shifted to the wall clock of ``tz`` (DST aware)."""
    return F.from_utc_timestamp(_c(ts), tz)
