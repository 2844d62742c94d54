"""Extraction watermark state: a control table of numbered commits.

One commit is made per successful extraction; the last one (by its number, not
by a clock) of each ``source_table`` is the current state.  A crash can never destroy the state, and
the state is written only after the data, so a crash in between re-extracts
the same rows (at-least-once; silver dedup absorbs the repeat).  Two
extractions at once cannot both commit on the same state: ``put_watermark``
with ``expected`` tells the later one (``CommitConflict``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import constants as K
from ledgerlake.functions.instants import from_micros, micros, to_micros
from ledgerlake.sinks.commitlog import CommitConflict, CommitLog
from ledgerlake.sources.incremental import typed_ts

ANY = object()


def watermark_log(spark: SparkSession, path: str) -> CommitLog:
    stored = "source_table string, last_watermark_us long, last_run_us long, last_row_count long, status string"
    return CommitLog(spark, path, stored, ("source_table",))


def _typed(rows: DataFrame) -> DataFrame:
    return rows.select(
        "source_table", F.timestamp_micros("last_watermark_us").alias("last_watermark"),
        F.timestamp_micros("last_run_us").alias("last_run_ts"), "last_row_count", "status", "seq",
    )


def read_watermark_state(spark: SparkSession, path: str) -> DataFrame:
    """The state table: the commits since the last checkpoint, and the last one of each table before it."""
    return _typed(watermark_log(spark, path).rows())


def _latest_state(spark: SparkSession, path: str, table: str) -> DataFrame:
    return _typed(watermark_log(spark, path).latest().filter(F.col("source_table") == table))


def watermark_state(
    spark: SparkSession, path: str, table: str = K.SOURCE_TABLE, first: dt.datetime | str = K.DEFAULT_WATERMARK
) -> tuple[dt.datetime, int | None]:
    """(current watermark in UTC, number of its commit); (``first``, None) when the table was never extracted."""
    row = _latest_state(spark, path, table).select(micros(F.col("last_watermark")).alias("w"), "seq").first()
    if row is None:
        return from_micros(to_micros(first)), None
    return from_micros(to_micros(first) if row.w is None else row.w), row.seq


def get_watermark(
    spark: SparkSession, path: str, table: str = K.SOURCE_TABLE, first: dt.datetime | str = K.DEFAULT_WATERMARK
) -> dt.datetime:
    """The current watermark (UTC), or ``first`` when the table was never extracted."""
    return watermark_state(spark, path, table, first)[0]


def watermark_status(spark: SparkSession, path: str, table: str = K.SOURCE_TABLE) -> DataFrame:
    """One row: watermark, last run and last row count, with 'never run' defaults."""
    # A global aggregate over the (at most one) latest row always yields one
    # row, with NULLs when the table was never extracted.
    latest = _latest_state(spark, path, table).agg(
        F.max("last_watermark").alias("w"), F.max("last_run_ts").alias("r"), F.max("last_row_count").alias("n")
    )
    return latest.select(
        F.lit(table).alias("source_table"),
        F.coalesce(F.col("w").cast("string"), F.lit("No watermark — first run")).alias("watermark"),
        F.coalesce(F.col("r").cast("string"), F.lit("Never")).alias("last_run"),
        F.coalesce(F.col("n"), F.lit(0).cast("long")).alias("last_row_count"),
    )


def put_watermark(
    spark: SparkSession,
    path: str,
    table: str,
    watermark: dt.datetime,
    row_count: int,
    run_ts: dt.datetime,
    status: str = "SUCCESS",
    expected: object = ANY,
) -> int:
    """Commit a new state and return its number.

    ``expected`` is the number of the table's state that this one follows (None:
    there was none); if another commit of the table came since, nothing is
    written and ``CommitConflict`` is raised.
    """
    row = {
        "source_table": table, "last_watermark_us": to_micros(watermark), "last_run_us": to_micros(run_ts),
        "last_row_count": int(row_count), "status": status,
    }

    def make(number: int) -> list[dict]:
        if expected is not ANY and (now := watermark_state(spark, path, table)[1]) != expected:
            raise CommitConflict(f"{table}: expected state {expected}, found {now}")
        return [row]

    return watermark_log(spark, path).append(make)


def next_watermark_frame(increment: DataFrame, ts_col: str = "MODIFIED_TS") -> DataFrame:
    """One row: the increment's maximum modification time and its row count."""
    return increment.agg(
        F.max(typed_ts(increment, ts_col)).alias("next_watermark"), F.count(F.lit(1)).alias("row_count")
    )


def next_watermark(increment: DataFrame, ts_col: str = "MODIFIED_TS") -> tuple[dt.datetime | None, int]:
    """(new watermark in UTC, rows) of an increment; ``(None, 0)`` when it is empty."""
    row = next_watermark_frame(increment, ts_col).select(micros(F.col("next_watermark")).alias("w"), "row_count").first()
    return from_micros(row.w), row.row_count
