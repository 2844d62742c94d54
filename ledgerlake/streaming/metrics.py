"""Metrics of streams that outlive the application.

Each micro-batch has one row: lines in, lines that did not decode, redelivered
events, rows that came to the table.  The row's key is (query, batch), so a
replayed batch counts once.  Rows are commits of a control table
(``sinks.commitlog``), so they are there after a restart.

The silver refresh records its batches itself, after the manifest's commit.  Queries with
a plain sink are recorded by a listener: counts observed on the
stream (``observed``) come with the progress of each batch.
"""

from __future__ import annotations

import datetime as dt
import logging
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ledgerlake.plans.config import LakeConfig
from ledgerlake.sinks.commitlog import CommitLog
from ledgerlake.sources.bronze import CORRUPT_VALUE_COLUMN

log = logging.getLogger("ledgerlake")

OBSERVATION = "ledgerlake_stream"


def metrics_log(spark: SparkSession, cfg: LakeConfig) -> CommitLog:
    stored = "query string, batch_id long, at_us long, rows_in long, rows_corrupt long, rows_duplicate long, rows_out long"
    return CommitLog(spark, cfg.stream_metrics, stored, ("query", "batch_id"))


def record_batch(
    spark: SparkSession, cfg: LakeConfig, query: str, batch_id: int, rows_in: int, rows_corrupt: int, rows_duplicate: int | None, rows_out: int
) -> None:
    row = {
        "query": query, "batch_id": batch_id, "at_us": time.time_ns() // 1000, "rows_in": rows_in, "rows_corrupt": rows_corrupt,
        "rows_duplicate": rows_duplicate, "rows_out": rows_out,
    }
    metrics_log(spark, cfg).append(lambda number: [row])


def stream_metrics(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """One row per query and micro-batch."""
    rows = metrics_log(spark, cfg).latest()
    return rows.withColumn("at", F.timestamp_micros("at_us")).drop("at_us", "seq")


def observed(events: DataFrame) -> DataFrame:
    """``events`` (decoded, with ``_corrupt_value``) counted by micro-batch for ``ProgressRecorder``."""
    corrupt = F.count_if(F.col(CORRUPT_VALUE_COLUMN).isNotNull())
    return events.observe(OBSERVATION, F.count(F.lit(1)).alias("rows_in"), corrupt.alias("rows_corrupt"))


class ProgressRecorder(StreamingQueryListener):
    """Records the batches of named queries whose stream is ``observed``; every row that comes in goes out."""

    def __init__(self, spark: SparkSession, cfg: LakeConfig):
        super().__init__()
        self.lake, self.cfg = spark, cfg

    def onQueryStarted(self, event) -> None:
        log.info("query %s started, run %s", event.name, event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        counts = p.observedMetrics.get(OBSERVATION)
        if p.name and counts is not None and counts["rows_in"]:
            record_batch(self.lake, self.cfg, p.name, p.batchId, counts["rows_in"], counts["rows_corrupt"], None, counts["rows_in"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        log.info("query %s ended at %s", event.id, dt.datetime.now(dt.timezone.utc))


def start_recording(spark: SparkSession, cfg: LakeConfig) -> ProgressRecorder:
    """Add a recorder to the session; stop it with ``spark.streams.removeListener``."""
    recorder = ProgressRecorder(spark, cfg)
    spark.streams.addListener(recorder)
    return recorder
