"""Hourly JSON files gathered into columnar ones, and the silver refresh that reads those.

The bronze stream leaves many small JSON files.  The compaction is a stream
over them: each micro-batch is written once as Parquet, its rows packed into files of the
advisory partition size by a rebalance, and one commit of a control table
names its directory.  The refresh reads the directories of the commits after the last one
it merged, and says how far it came in the same commit that places the merged
dates.  So every line is handed over exactly once, whatever crashes in between:

* before the compaction's commit: the directory counts for nothing, and the batch is written again;
* after it, before the stream's own progress: the replayed batch finds its number committed and is skipped;
* before the refresh's commit: neither the dates nor the progress moved;
* two refreshes at once: the second one to commit finds the progress moved, and drops its work.

Lines that do not decode are kept as they are, like in the JSON files.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.plans.config import LakeConfig
from ledgerlake.plans.pipelines import run_gold_events_incremental
from ledgerlake.sinks.commitlog import CommitConflict, CommitLog
from ledgerlake.sources.bronze import BRONZE_LOAN_EVENTS_READ, CORRUPT_COLUMN
from ledgerlake.streaming.refresh import AlreadyMerged, compacted_upto, current_silver_events, merge_events_batch, silver_event_dates

log = logging.getLogger("ledgerlake")

COMPACT_REFRESH = "silver_events_compacted"


def compaction_log(spark: SparkSession, cfg: LakeConfig) -> CommitLog:
    return CommitLog(spark, cfg.compacted, "batch_id long, directory string", ("batch_id",))


def compact_batch(spark: SparkSession, cfg: LakeConfig, batch: DataFrame, batch_id: int) -> None:
    log_ = compaction_log(spark, cfg)
    if not log_.latest().filter(f"batch_id = {batch_id}").isEmpty():
        return  # replayed after its commit
    directory = f"batch=b{batch_id:010d}-{uuid.uuid4().hex}"
    batch.hint("rebalance").write.parquet(f"{cfg.bronze_events_compact}/{directory}")

    def make(number: int) -> list[dict]:
        if not log_.latest().filter(f"batch_id = {batch_id}").isEmpty():
            raise CommitConflict(f"batch {batch_id} was compacted by another run")
        return [{"batch_id": batch_id, "directory": directory}]

    log_.append(make)


def compact_bronze_events(spark: SparkSession, cfg: LakeConfig, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Compact the bronze events that arrived since the last run; returns the (finishing) query."""
    reader = spark.readStream.schema(BRONZE_LOAN_EVENTS_READ).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.json(cfg.bronze_events).select(*BRONZE_LOAN_EVENTS_READ.fieldNames())
    return (
        stream.writeStream.foreachBatch(lambda df, bid: compact_batch(spark, cfg, df, bid))
        .option("checkpointLocation", cfg.checkpoint("bronze_events_compact"))
        .trigger(availableNow=True)
        .start()
    )


def refresh_from_compacted(spark: SparkSession, cfg: LakeConfig, run_ts: dt.datetime | str | None = None, batches: int = 64) -> int:
    """Merge compacted events not merged yet into silver, ``batches`` compaction batches at a time; how many were merged."""
    done = 0
    while True:
        after = compacted_upto(spark, cfg)
        new = compaction_log(spark, cfg).latest().filter(f"seq > {after}").orderBy("seq").limit(batches).collect()
        if not new:
            return done
        paths = [f"{cfg.bronze_events_compact}/{r.directory}" for r in new]
        rows = spark.read.schema(BRONZE_LOAN_EVENTS_READ).parquet(*paths)
        try:
            merge_events_batch(spark, cfg, rows, new[-1].seq, run_ts, query=COMPACT_REFRESH, after=after)
            done += len(new)
        except AlreadyMerged as e:
            log.info("%s; going on from there", e)


def refresh_gold_from_compacted(spark: SparkSession, cfg: LakeConfig, run_ts: dt.datetime | None = None) -> dict:
    """Compact what arrived, merge it into silver, then refresh the event facts' stale dates."""
    compact_bronze_events(spark, cfg).awaitTermination()
    merged = refresh_from_compacted(spark, cfg, run_ts)
    events = current_silver_events(spark, cfg)
    if events is None:
        return {"compacted_batches": merged, "fact_loan_event_activity": 0, "fact_event_summary": 0}
    gold = run_gold_events_incremental(spark, cfg, run_ts, silver_events=events, changes=silver_event_dates(spark, cfg))
    return {"compacted_batches": merged, **gold}
