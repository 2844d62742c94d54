"""The loan history kept by month of ``valid_from``, merged from each extraction.

A merge writes only the months that hold a patched or a new row, into a
directory of its own, and one commit of the manifest says where each of these
months now is and how far bronze was read.  So the data and the progress are
never apart: a crash before the commit leaves both as they were.  Months without a
change keep their files.  A merge that lost its months to another writer is done again.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import constants as K
from ledgerlake.functions.instants import from_micros, instant, micros, to_micros
from ledgerlake.operators.history import HISTORY_COLUMNS, apply_changes, covering, history_changes, versions_of
from ledgerlake.operators.normalize import normalize_loan_master
from ledgerlake.plans.config import LakeConfig
from ledgerlake.session import checkpoint_dir
from ledgerlake.sinks.commitlog import CommitConflict, CommitLog
from ledgerlake.sinks.files import rebalanced
from ledgerlake.sources.bronze import read_bronze_master
from ledgerlake.sources.incremental import typed_ts

log = logging.getLogger("ledgerlake")

#: The manifest's row that says how far bronze was merged.
PROGRESS = "_merged_to"
NO_MONTH = "none"


def history_log(spark: SparkSession, cfg: LakeConfig) -> CommitLog:
    """Per month its directory; in the row PROGRESS the newest ingestion time merged (``at_us``)."""
    return CommitLog(spark, cfg.history_months, "month string, directory string, at_us long", ("month",))


def month_of(valid_from: str) -> Column:
    return F.coalesce(F.date_format(valid_from, "yyyy-MM"), F.lit(NO_MONTH))


def month_directory(directory: str, month: str) -> str:
    return f"{directory}/valid_month={month}"


def _read(spark: SparkSession, cfg: LakeConfig, state: dict, months: set[str] | None = None) -> DataFrame | None:
    root = cfg.history
    paths = [f"{root}/{month_directory(r.directory, m)}" for m, r in sorted(state.items()) if m != PROGRESS and (months is None or m in months)]
    return spark.read.parquet(*paths).select(*HISTORY_COLUMNS) if paths else None


def _state(spark: SparkSession, cfg: LakeConfig) -> dict:
    return {r.month: r for r in history_log(spark, cfg).latest().collect()}


def current_history(spark: SparkSession, cfg: LakeConfig) -> DataFrame | None:
    """The history as last merged; None before the first merge."""
    return _read(spark, cfg, _state(spark, cfg))


def run_history_incremental(spark: SparkSession, cfg: LakeConfig, run_ts: dt.datetime | None = None, attempts: int = 5) -> dict:
    """Merge bronze rows ingested since the last merge; merged again if another writer committed meanwhile."""
    for attempt in range(attempts):
        try:
            return _merge(spark, cfg)
        except CommitConflict as e:
            if attempt == attempts - 1:
                raise
            log.info("%s; merging again", e)


def _merge(spark: SparkSession, cfg: LakeConfig) -> dict:
    checkpoint_dir(spark)
    state = _state(spark, cfg)
    merged_to = from_micros(state[PROGRESS].at_us) if PROGRESS in state else None
    bronze = read_bronze_master(spark, cfg.bronze_master)
    if merged_to is not None:
        day = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))
        ingested = typed_ts(bronze, "_ingestion_ts", K.MODIFIED_TS_FORMAT)
        bronze = bronze.filter((day >= F.to_date(instant(merged_to))) & (ingested >= instant(merged_to)))
    # The increment is read several times from here on.
    versions = versions_of(normalize_loan_master(bronze)).checkpoint()
    newest = versions.agg(F.max(micros(F.col("_ingestion_ts")))).first()[0]
    if newest is None or (merged_to is not None and newest <= to_micros(merged_to)):
        return {"months": 0, "merged_to": merged_to}
    empty = versions.limit(0).withColumns({"valid_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True)}).select(*HISTORY_COLUMNS)
    present = _read(spark, cfg, state)
    located = covering(versions, empty if present is None else present).checkpoint()
    rows, patches = history_changes(located)
    rows, patches = rows.checkpoint(), patches.checkpoint()
    touched = rows.select(month_of("valid_from").alias("m")).unionByName(patches.select(month_of("valid_from").alias("m"))).distinct()
    months = {r.m for r in touched.collect()}  # bounded by the calendar
    directory = f"batch={uuid.uuid4().hex}"
    if months:
        base = _read(spark, cfg, state, months)
        merged = apply_changes(empty if base is None else base, rows, patches).withColumn("valid_month", month_of("valid_from"))
        rebalanced(merged, ["valid_month"]).write.partitionBy("valid_month").parquet(f"{cfg.history}/{directory}")
    commit = [{"month": m, "directory": directory, "at_us": None} for m in sorted(months)] + [{"month": PROGRESS, "directory": None, "at_us": newest}]
    seq = state[PROGRESS].seq if PROGRESS in state else None

    def make(number: int) -> list[dict]:
        now = _state(spark, cfg)
        if (now[PROGRESS].seq if PROGRESS in now else None) != seq:
            raise CommitConflict("the history was merged by another writer")
        return commit

    history_log(spark, cfg).append(make)
    return {"months": len(months), "merged_to": from_micros(newest)}
