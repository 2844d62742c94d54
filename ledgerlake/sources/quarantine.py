"""Source rows whose modification time does not parse, taken once.

Such a row cannot be placed before or after a watermark, so every extraction
would take it again.  The quarantine is a side table of the rows that were
taken: a hash over all of a row's columns, the time's text and the row as JSON.
An increment leaves out rows it holds; a row that changes in any column has another
hash and is taken again.  Rows are recorded after they are in bronze, so a
crash in between takes them once more and loses none.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.instants import instant
from ledgerlake.schemas import QUARANTINE
from ledgerlake.sinks.files import is_missing
from ledgerlake.sources.incremental import typed_ts


def row_json(columns: Sequence[str]) -> Column:
    """A row as JSON text, NULLs written out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def read_quarantine(spark: SparkSession, path: str) -> DataFrame | None:
    """The quarantined rows; None before the first."""
    try:
        return spark.read.schema(QUARANTINE).parquet(path)
    except AnalysisException as e:
        if not is_missing(e):
            raise
        return None


def without_known(increment: DataFrame, ts_col: str, known: DataFrame) -> DataFrame:
    """``increment`` without the rows of unparsable time whose hash ``known`` (row_hash) holds.

    All other rows pass the anti join under a hash of their own in place of a
    NULL, which would send them all to one task.  AQE broadcasts a small
    ``known``; else the join is spread by the hashes, and copies of one row by the skew rule.
    """
    columns = increment.columns
    spread = F.concat(F.lit("-"), F.xxhash64(*columns).cast("string"))
    key = F.when(typed_ts(increment, ts_col).isNull(), F.sha2(row_json(columns), 256)).otherwise(spread)
    keyed = increment.select(F.struct(*columns).alias("r"), key.alias("k"))
    hashes = known.select(F.col("row_hash").alias("k")).distinct()
    return keyed.join(hashes, "k", "left_anti").select("r.*")


def quarantine_rows(rows: DataFrame, ts_col: str, columns: Sequence[str], source_table: str, run_ts: dt.datetime) -> DataFrame:
    """The quarantine's rows for those of ``rows`` whose time does not parse, one per hash of ``columns``."""
    bad = rows.filter(typed_ts(rows, ts_col).isNull())
    content = row_json(columns)
    return bad.select(
        F.lit(source_table).alias("source_table"), F.sha2(content, 256).alias("row_hash"), F.col(ts_col).cast("string").alias("time_text"),
        content.alias("row_json"), instant(run_ts).alias("first_seen"),
    ).dropDuplicates(["row_hash"])
