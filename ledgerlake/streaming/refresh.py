"""Incremental silver/gold refresh driven by Structured Streaming.

``refresh_silver_events`` reads only bronze files that arrived since the
last run (the file source's checkpoint remembers them), and runs once over
everything available (``availableNow``).

The incremental silver table is kept by ``event_date``; every copy of an event
shares its date, because ``event_ts`` is part of the event identity.  Each
micro-batch therefore only touches the dates its events fall in: their present
rows are read (found in the manifest, a set bounded by the calendar), merged
with the batch (``merge_latest``) and written to a *new* directory of the batch;
then a commit of the manifest says where each date now is.  Nothing
that is being read is ever overwritten, and a crash before the commit
leaves the table as it was, so the batch is simply merged again.  A replayed
batch merges the same rows, which is idempotent.  The manifest's numbering also
tells the gold refresh which dates changed.  Commits are checkpointed
(``sinks.commitlog``): readers take one checkpoint and the few commits after it.

``row_number`` dedup and exact ``count(distinct)`` are not available on a
streaming DataFrame, which is why the merge runs inside ``foreachBatch``
(plain DataFrames) and the gold summary is recomputed from the refreshed
silver table.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake import constants as K
from ledgerlake.operators.dedup import EVENT_KEYS, EVENT_RANK, event_order, latest_per_key, merge_latest
from ledgerlake.operators.lineage import add_silver_lineage
from ledgerlake.operators.metrics import with_run_metrics
from ledgerlake.operators.normalize import normalize_loan_events
from ledgerlake.plans.config import LakeConfig
from ledgerlake.plans.layers import decodable
from ledgerlake.plans.pipelines import run_gold_events, run_gold_events_incremental
from ledgerlake.sinks.commitlog import CommitConflict, CommitLog
from ledgerlake.sinks.files import rebalanced
from ledgerlake.sources.bronze import BRONZE_LOAN_EVENTS_READ, CORRUPT_COLUMN
from ledgerlake.streaming.metrics import record_batch

#: The manifest's row that says how far the compacted events were read (its batch_id; it has no directory).
COMPACTED_UPTO = "_compacted_upto"
#: The silver refresh in the stream metrics.
REFRESH_QUERY = "silver_events"


def manifest_log(spark: SparkSession, cfg: LakeConfig) -> CommitLog:
    return CommitLog(spark, cfg.silver_event_dates, "event_date string, directory string, batch_id long", ("event_date",))


def silver_event_dates(spark: SparkSession, cfg: LakeConfig) -> DataFrame | None:
    """The manifest: where each date of the silver events was written last, and in which commit (``seq``); None before the first refresh.

    Read from one checkpoint and the commits after it.
    """
    manifest = manifest_log(spark, cfg)
    if manifest.head() < 0:
        return None
    dates = manifest.latest().filter(F.col("directory").isNotNull())
    return dates.select(F.col("event_date").cast("date").alias("event_date"), "seq", "directory", "batch_id")


def compacted_upto(spark: SparkSession, cfg: LakeConfig) -> int:
    """The last commit of the compaction that the silver events hold; -1 for none."""
    row = manifest_log(spark, cfg).latest().filter(F.col("event_date") == COMPACTED_UPTO).first()
    return -1 if row is None else row.batch_id


def partition_directory(directory: str, event_date: dt.date | str | None) -> str:
    """Where a date's rows lie within the incremental silver events."""
    return f"{directory}/event_date={event_date or '__HIVE_DEFAULT_PARTITION__'}"


def _located(spark: SparkSession, cfg: LakeConfig, dates: list | None = None) -> list:
    """Manifest rows of ``dates`` (default: all), a set bounded by the calendar."""
    manifest = silver_event_dates(spark, cfg)
    return [] if manifest is None else [r for r in manifest.collect() if dates is None or r.event_date in dates]


def _present(spark: SparkSession, cfg: LakeConfig, wanted: list) -> DataFrame | None:
    """Silver events of the manifest rows ``wanted``, read from the directories that they name."""
    if not wanted:
        return None
    root = cfg.silver_events_incremental
    paths = [f"{root}/{partition_directory(r.directory, r.event_date)}" for r in wanted]
    rows = spark.read.option("basePath", root).parquet(*paths).drop("batch")
    return rows.withColumn("event_date", F.col("event_date").cast("date"))


def merge_events_batch(
    spark: SparkSession, cfg: LakeConfig, batch: DataFrame, batch_id: int, run_ts, attempts: int = 5, query: str = REFRESH_QUERY, after: int | None = None
) -> None:
    """Merge a batch into its dates; merged anew if another writer committed one of them meanwhile.

    A batch of compacted events says after which compaction commit it begins
    (``after``; ``batch_id`` is where it ends): the progress is part of the dates' commit.
    """
    batch = batch.persist()
    try:
        typed = add_silver_lineage(normalize_loan_events(decodable(batch)), K.JOB_SILVER_EVENTS, run_ts)
        typed = typed.withColumn("event_date", F.to_date("event_ts"))
        found = {r.event_date: r.n for r in typed.groupBy("event_date").agg(F.count(F.lit(1)).alias("n")).collect()}
        dates, rows_in, rows_ok = list(found), batch.count(), sum(found.values())
        if not dates:
            if after is not None:
                commit_dates(spark, cfg, [], "", batch_id, [], after)
            record_batch(spark, cfg, query, batch_id, rows_in, rows_in, 0, 0)
            return
        for attempt in range(attempts):
            seen = _located(spark, cfg, dates)
            current = _present(spark, cfg, seen)
            if current is None:
                merged = latest_per_key(typed, EVENT_KEYS, event_order())
            else:
                merged = merge_latest(current.select(*typed.columns), typed, EVENT_KEYS, EVENT_RANK)
            # Every attempt has a directory of its own; only the manifest makes it count.
            directory = f"batch=b{batch_id:010d}-{uuid.uuid4().hex}"
            merged, obs = with_run_metrics(rebalanced(merged, ["event_date"]), "silver_events_batch")
            merged.write.partitionBy("event_date").parquet(f"{cfg.silver_events_incremental}/{directory}")
            came = obs.get["rows"] - (0 if current is None else current.count())
            try:
                commit_dates(spark, cfg, dates, directory, batch_id, seen, after)
                record_batch(spark, cfg, query, batch_id, rows_in, rows_in - rows_ok, rows_ok - came, came)
                return
            except CommitConflict:
                if attempt == attempts - 1:
                    raise
    finally:
        batch.unpersist()


class AlreadyMerged(RuntimeError):
    """Another run has read these compacted events."""


def commit_dates(
    spark: SparkSession, cfg: LakeConfig, dates: list, directory: str, batch_id: int, seen: list, after: int | None = None
) -> int:
    """Make ``directory`` the place of ``dates``, if each is still where the manifest rows ``seen`` had it."""
    rows = [{"event_date": None if d is None else d.isoformat(), "directory": directory, "batch_id": batch_id} for d in dates]
    if after is not None:
        rows.append({"event_date": COMPACTED_UPTO, "directory": None, "batch_id": batch_id})

    def make(number: int) -> list[dict]:
        if after is not None and compacted_upto(spark, cfg) != after:
            raise AlreadyMerged(f"compacted events after {after} were merged by another run")
        if {(r.event_date, r.seq) for r in _located(spark, cfg, dates)} != {(r.event_date, r.seq) for r in seen}:
            raise CommitConflict(f"dates of {directory} were committed by another writer")
        return rows

    return manifest_log(spark, cfg).append(make)


def refresh_silver_events(
    spark: SparkSession,
    cfg: LakeConfig,
    run_ts: dt.datetime | str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Merge newly landed bronze events into silver; returns the (finishing) query.

    ``max_files_per_trigger`` bounds each micro-batch (``availableNow`` then
    processes a large backlog as several bounded batches).
    """
    reader = (
        spark.readStream.schema(BRONZE_LOAN_EVENTS_READ)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.json(cfg.bronze_events)
    return (
        stream.writeStream.foreachBatch(lambda df, bid: merge_events_batch(spark, cfg, df, bid, run_ts))
        .option("checkpointLocation", cfg.checkpoint("silver_events"))
        .trigger(availableNow=True)
        .start()
    )


def current_silver_events(spark: SparkSession, cfg: LakeConfig) -> DataFrame | None:
    """The incrementally maintained silver events, or None before the first refresh."""
    return _present(spark, cfg, _located(spark, cfg))


def refresh_gold_events(
    spark: SparkSession, cfg: LakeConfig, run_ts: dt.datetime | None = None, incremental: bool = False
) -> dict:
    """Run the silver refresh to completion, then refresh the event facts from current silver.

    ``incremental=False`` rebuilds the event-type partitioned facts in full;
    ``incremental=True`` recomputes only stale dates of the date-partitioned
    facts (``run_gold_events_incremental``).
    """
    q = refresh_silver_events(spark, cfg, run_ts)
    q.awaitTermination()
    events = current_silver_events(spark, cfg)
    if events is None:
        return {"fact_loan_event_activity": 0, "fact_event_summary": 0}
    ts = run_ts if isinstance(run_ts, dt.datetime) else None
    if incremental:
        return run_gold_events_incremental(spark, cfg, ts, silver_events=events, changes=silver_event_dates(spark, cfg))
    return run_gold_events(spark, cfg, ts, silver_events=events)
