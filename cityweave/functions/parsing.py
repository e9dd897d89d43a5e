"""Tolerant parsing of text fields (ANSI mode raises where the marts want NULL)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def decimal_comma_to_double(col) -> Column:
    """``'-33,865'`` -> ``-33.865``; malformed text -> NULL."""
    return F.regexp_replace(_c(col).cast("string"), ",", ".").try_cast("double")


def to_user_id(col) -> Column:
    """User ids as bigint from string or integer fields; malformed -> NULL.

    Ids are kept 64-bit end to end, so 3000000000 stays 3000000000.
    """
    return _c(col).cast("string").try_cast("bigint")


def parse_timestamp(col) -> Column:
    """Event time text -> timestamp (session time zone, UTC); malformed -> NULL."""
    return F.try_to_timestamp(_c(col).cast("string"))


def event_time(message_ts="message_ts", datetime="datetime") -> Column:
    """Time of an event: the message time if present, else the generic one."""
    return parse_timestamp(F.coalesce(_c(message_ts), _c(datetime)))
