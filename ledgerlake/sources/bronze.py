"""Bronze and lake-table readers.

JSON is always read with an explicit schema: inference costs a full extra
pass over the data and fails on an empty directory.  Malformed JSON lines
are kept (PERMISSIVE mode) with their raw text in ``_corrupt_record``.
Parquet carries its schema in the footers; silver casts whatever numeric
type the extraction wrote (double, decimal, or text).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.schemas import BRONZE_LOAN_EVENTS, BRONZE_LOAN_MASTER

# Malformed JSON *lines* of a bronze file (filled by the JSON reader).
CORRUPT_COLUMN = "_corrupt_record"
# Well-formed bronze lines whose topic payload did not decode (filled at ingest).
CORRUPT_VALUE_COLUMN = "_corrupt_value"

BRONZE_LOAN_EVENTS_READ = T.StructType(
    BRONZE_LOAN_EVENTS.fields
    + [T.StructField(CORRUPT_VALUE_COLUMN, T.StringType()), T.StructField(CORRUPT_COLUMN, T.StringType())]
)


def read_bronze_master(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Bronze loan master Parquet under ``year=/month=/day=`` directories, with all of its known columns.

    Files of several writers may differ in columns, so footers are merged, and
    a column of BRONZE_LOAN_MASTER that no file has is there as NULL.  ``schema``
    skips the footers where the caller knows what the files hold.
    """
    rows = spark.read.schema(schema).parquet(path) if schema is not None else spark.read.option("mergeSchema", "true").parquet(path)
    absent = [f for f in BRONZE_LOAN_MASTER.fields if f.name not in rows.columns]
    return rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent}) if absent else rows


def read_ingested(spark: SparkSession, path: str, run_ts: dt.datetime) -> DataFrame:
    """Bronze rows of one ingestion day: only its directory is listed and read."""
    return spark.read.parquet(f"{path.rstrip('/')}/year={run_ts:%Y}/month={run_ts:%m}/day={run_ts:%d}")


def read_bronze_events(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Bronze loan events (JSON lines or Parquet) under ``year=/month=/day=/hour=`` directories."""
    if fmt == "json":
        return (
            spark.read.schema(BRONZE_LOAN_EVENTS_READ)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
            .json(path)
        )
    return spark.read.schema(BRONZE_LOAN_EVENTS).format(fmt).load(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A silver or gold Parquet table (partition columns discovered from directories)."""
    return spark.read.parquet(path)
