"""Column-level building blocks (all built-in Spark expressions, no UDFs)."""

from cityweave.functions.calendar import DEFAULT_TIME_ZONE, iso_week_of, local_time, month_of
from cityweave.functions.geo import (
    EARTH_RADIUS_KM,
    cell_width,
    grid_cell,
    haversine_km,
)
from cityweave.functions.parsing import (
    decimal_comma_to_double,
    event_time,
    parse_timestamp,
    to_user_id,
)

__all__ = [
    "DEFAULT_TIME_ZONE",
    "EARTH_RADIUS_KM",
    "cell_width",
    "decimal_comma_to_double",
    "event_time",
    "grid_cell",
    "haversine_km",
    "iso_week_of",
    "local_time",
    "month_of",
    "parse_timestamp",
    "to_user_id",
]
