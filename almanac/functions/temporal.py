"""Time expressions over naive UTC timestamps (session zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def truncated(unit: str, ts: Column) -> Column:
    """``date_trunc`` that keeps the naive type."""
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def local_time(ts: Column, zone: str) -> Column:
    return F.from_utc_timestamp(ts.cast("timestamp"), zone).cast("timestamp_ntz")


def sort_key(ts: Column) -> Column:
    """A long that orders like the timestamp."""
    return F.unix_micros(ts.cast("timestamp"))
