"""Points in time outside Spark, free of the driver's time zone.

A Python datetime here is naive and means UTC.  Spark turns timestamps into the
operating system's zone when it hands them to Python, and back when it takes
them; so times cross that border as microseconds since the epoch, never as
datetimes.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = dt.datetime(1970, 1, 1)


def to_micros(value: dt.datetime | str | int) -> int:
    """Microseconds since the epoch of a naive (UTC) or aware datetime, or of its ISO text."""
    if isinstance(value, int):
        return value
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return (value - EPOCH) // dt.timedelta(microseconds=1)


def from_micros(micros: int | None) -> dt.datetime | None:
    return None if micros is None else EPOCH + dt.timedelta(microseconds=micros)


def instant(value: dt.datetime | str | int) -> Column:
    """A TIMESTAMP literal."""
    return F.timestamp_micros(F.lit(to_micros(value)).cast("bigint"))


def micros(column: Column) -> Column:
    """A timestamp column (or timestamp without zone, read as UTC) as microseconds, to be collected."""
    return F.unix_micros(column.cast("timestamp"))
