"""Readers and writers of flight records."""

from skyledger.sources.readers import (
    TooManyBadRecords,
    on_new_flights,
    read_airports,
    read_flights_checked,
    read_flights_csv,
    read_flights_parquet,
    read_flights_table,
    stream_flights,
    stream_new_contents,
)
from skyledger.sources.writers import consolidate_csv, write_bucketed, write_per_year

__all__ = [
    "TooManyBadRecords",
    "consolidate_csv",
    "on_new_flights",
    "read_airports",
    "read_flights_checked",
    "read_flights_csv",
    "read_flights_parquet",
    "read_flights_table",
    "stream_flights",
    "stream_new_contents",
    "write_bucketed",
    "write_per_year",
]
