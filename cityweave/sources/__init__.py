"""Readers and writers: city CSV, date-partitioned event log, mart sink."""

from cityweave.sources.cities import parse_city_dictionary, read_cities, read_city_text
from cityweave.sources.contract import EVENT_CONTRACT, reconciled
from cityweave.sources.events import date_window, day_paths, flatten_events, read_events
from cityweave.sources.sinks import preview, write_mart

__all__ = [
    "EVENT_CONTRACT",
    "date_window",
    "day_paths",
    "flatten_events",
    "parse_city_dictionary",
    "preview",
    "read_cities",
    "read_city_text",
    "read_events",
    "reconciled",
    "write_mart",
]
