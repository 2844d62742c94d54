"""Provenance and lineage columns for each layer.

Every timestamp takes an explicit ``run_ts`` so a rerun is reproducible;
``None`` means the query's start time (``current_timestamp``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import constants as K
from ledgerlake.functions import as_timestamp

BRONZE_PROVENANCE = ("_source_table", "_source_system", "_watermark_start", "_source_topic", "_producer_version")


def ingestion_text(run_ts: dt.datetime) -> str:
    """The ``_ingestion_ts`` of a run, as ``add_ingest_columns`` writes it."""
    return run_ts.strftime("%Y-%m-%d %H:%M:%S")


def _ts(run_ts: dt.datetime | str | None) -> Column:
    return F.current_timestamp() if run_ts is None else as_timestamp(run_ts)


def add_ingest_columns(
    df: DataFrame,
    source_table: str = K.SOURCE_TABLE,
    source_system: str = K.SOURCE_SYSTEM,
    watermark: dt.datetime | str = K.DEFAULT_WATERMARK,
    run_ts: dt.datetime | str | None = None,
) -> DataFrame:
    """Bronze provenance, as source-system text: table, system, ingestion time, watermark start."""
    wm = watermark.isoformat(sep=" ", timespec="seconds") if isinstance(watermark, dt.datetime) else str(watermark)
    return df.withColumns(
        {
            "_source_table": F.lit(source_table),
            "_source_system": F.lit(source_system),
            "_ingestion_ts": F.date_format(_ts(run_ts), K.MODIFIED_TS_FORMAT),
            "_watermark_start": F.lit(wm),
        }
    )


def add_silver_lineage(
    df: DataFrame, job: str, run_ts: dt.datetime | str | None = None, source_layer: str = K.SOURCE_LAYER_BRONZE
) -> DataFrame:
    """Silver stamps; bronze-only provenance columns are dropped if present."""
    return df.drop(*BRONZE_PROVENANCE).withColumns(
        {"_silver_ts": _ts(run_ts), "_silver_job": F.lit(job), "_source_layer": F.lit(source_layer)}
    )


def add_gold_lineage(df: DataFrame, job: str, run_ts: dt.datetime | str | None = None) -> DataFrame:
    return df.withColumns({"_gold_job": F.lit(job), "_gold_ts": _ts(run_ts)})
