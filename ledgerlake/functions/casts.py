"""Null-on-failure casts for the silver layer.

Spark 4 runs with ANSI mode on, where a bad cast or an unparsable date
raises.  Silver must turn malformed source values into NULL and keep going,
so it uses the ``try_*`` family, which stays JVM-side and inside codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def safe_cast(c: Column | str, to: T.DataType) -> Column:
    """Cast, giving NULL instead of an error on malformed or overflowing input."""
    return F.col(c).try_cast(to) if isinstance(c, str) else c.try_cast(to)


def safe_date(c: Column | str, fmt: str) -> Column:
    """Parse text (or anything castable to text) as a date; NULL when invalid."""
    return F.try_to_date(safe_cast(c, T.StringType()), fmt)


def safe_timestamp(c: Column | str, fmt: str | None = None) -> Column:
    """Parse a timestamp with an explicit format, or ISO-8601 when ``fmt`` is None."""
    text = safe_cast(c, T.StringType())
    if fmt is None:
        return F.try_to_timestamp(text)
    return F.try_to_timestamp(text, F.lit(fmt))
