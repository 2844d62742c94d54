"""High-water-mark incremental extraction from a source table.

The source is any DataFrame: a JDBC table (``spark.read.jdbc`` with
``partitionColumn``/``numPartitions`` for a parallel read), a Parquet
landing area, or a catalog table.  The comparison is typed: when the source
keeps its modification time as text it is parsed with the source format
first, so ``'2024-1-5'`` style values are not compared lexicographically.
A timestamp-typed column is compared directly and the predicate reaches the
scan (``PushedFilters`` for Parquet; a ``WHERE`` clause for JDBC).  For a text
column the source gets a bound of its own (``sources.bounds``), which keeps a
superset; the typed comparison stays on top of it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import constants as K
from ledgerlake.functions import safe_timestamp
from ledgerlake.functions.instants import from_micros, to_micros
from ledgerlake.sources.bounds import bounded_select


def typed_ts(df: DataFrame, ts_col: str, fmt: str = K.MODIFIED_TS_FORMAT) -> Column:
    """The modification-time column as a timestamp, whatever its source type.

    Text is read in the source's format, else as any ISO-8601 time (fractions
    of a second, ``T``, an offset); NULL if it is neither.
    """
    dtype = df.schema[ts_col].dataType
    if isinstance(dtype, T.StringType):
        return F.coalesce(safe_timestamp(F.col(ts_col), fmt), safe_timestamp(F.col(ts_col)))
    return F.col(ts_col)


def read_incremental(
    src: DataFrame,
    ts_col: str,
    watermark: dt.datetime | str,
    lookback: dt.timedelta | None = None,
    fmt: str = K.MODIFIED_TS_FORMAT,
) -> DataFrame:
    """Rows modified strictly after ``watermark`` (minus an optional ``lookback``).

    ``lookback`` re-reads a margin of already-extracted rows so that late
    commits sharing the watermark's second are not lost; silver dedup makes
    the overlap harmless.  Rows of a text column whose time does not parse (or
    is NULL) cannot be placed before the watermark, so every run takes them
    again rather than lose them; silver ranks them last and absorbs the repeat.
    """
    wm = from_micros(to_micros(watermark))
    if lookback is not None:
        wm = wm - lookback
    dtype = src.schema[ts_col].dataType
    text = wm.isoformat(sep=" ", timespec="microseconds")
    bound = F.lit(text).cast(T.TimestampNTZType() if isinstance(dtype, T.TimestampNTZType) else T.TimestampType())
    newer = typed_ts(src, ts_col, fmt) > bound
    if isinstance(dtype, T.StringType):
        return src.filter(newer | typed_ts(src, ts_col, fmt).isNull())
    return src.filter(newer)


def jdbc_source(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    text_time: str | None = None,
    watermark: dt.datetime | str | None = None,
    substring: str = "SUBSTRING",
) -> DataFrame:
    """A JDBC table as a DataFrame; give a numeric ``partition_column`` for a parallel read.

    ``text_time`` names a column that holds its modification time as text: rows
    certainly older than ``watermark`` then stay in the database (``bounded_select``).
    """
    options = jdbc_options(url, table, properties, partition_column, lower_bound, upper_bound, num_partitions, text_time, watermark, substring)
    return spark.read.format("jdbc").options(**options).load()


def jdbc_options(
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    text_time: str | None = None,
    watermark: dt.datetime | str | None = None,
    substring: str = "SUBSTRING",
) -> dict[str, str]:
    """What ``jdbc_source`` asks the connector for."""
    if text_time is not None and watermark is not None:
        table = f"({bounded_select(table, text_time, watermark, substring)}) bounded"
    options = {"url": url, "dbtable": table, **(properties or {})}
    if partition_column is not None:
        options |= {"partitionColumn": partition_column, "lowerBound": str(lower_bound), "upperBound": str(upper_bound), "numPartitions": str(num_partitions)}
    return options
