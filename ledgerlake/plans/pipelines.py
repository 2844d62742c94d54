"""Batch pipelines: extract -> bronze -> silver -> gold -> catalog.

Each step reads the previous step's *written* table, so lineage never grows
across steps and a failed step is rerun alone.  Counts come from
``Observation``s attached to the writes (one job per output, not an extra
``count()`` per metric).  Order of the extract step gives at-least-once:
data first, watermark after; a crash in between re-extracts the same rows
and silver dedup absorbs them.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import constants as K
from ledgerlake.functions.instants import from_micros, instant, micros, to_micros
from ledgerlake.operators.dedup import MASTER_KEYS, MASTER_RANK, latest_per_key, master_order, merge_latest
from ledgerlake.operators.facts import fact_loan_event_activity, fact_loan_performance
from ledgerlake.operators.lineage import add_ingest_columns, add_silver_lineage, ingestion_text
from ledgerlake.operators.metrics import with_run_metrics
from ledgerlake.operators.normalize import normalize_loan_master
from ledgerlake.operators.summary import event_summary, event_type_totals
from ledgerlake.plans.config import LakeConfig
from ledgerlake.plans.layers import silver_loan_events, silver_loan_master
from ledgerlake.schemas import SILVER_LOAN_MASTER_COLUMNS
from ledgerlake.sinks.catalog import repoint_table
from ledgerlake.sinks.commitlog import CommitConflict
from ledgerlake.sinks.files import (
    append_bronze,
    is_missing,
    overwrite_table,
    publish_version,
    rebalanced,
    version_info,
    write_version,
)
from ledgerlake.sources.bronze import read_bronze_events, read_bronze_master, read_ingested, read_table
from ledgerlake.sources.dims import dim_loan_type, dim_status
from ledgerlake.sources.incremental import read_incremental, typed_ts
from ledgerlake.sources.quarantine import quarantine_rows, read_quarantine, without_known
from ledgerlake.sources.watermark import put_watermark, watermark_state, watermark_status

log = logging.getLogger("ledgerlake")


def _now(run_ts: dt.datetime | None) -> dt.datetime:
    return run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)


def run_extract(spark: SparkSession, source: DataFrame, cfg: LakeConfig, run_ts: dt.datetime | None = None) -> dict:
    """Extract rows modified after the stored watermark into bronze, then advance it.

    The source is read once: the write itself counts the rows, and writes no
    file when there are none.  Rows whose text time does not parse are taken
    into bronze once and counted (``unparsed``); the quarantine remembers them,
    so an unchanged source yields nothing on the next run.  They do not move the watermark.

    Bronze is written first, then the quarantine, then the watermark: a crash in
    between takes the same rows again.  If another extraction committed its
    watermark meanwhile, the later of the two counts, as the rows of both are in bronze.
    """
    run_ts = _now(run_ts)
    wm, seq = watermark_state(spark, cfg.watermarks, cfg.source_table, cfg.first_watermark)
    increment = read_incremental(source, "MODIFIED_TS", wm, cfg.lookback)
    known = read_quarantine(spark, cfg.quarantine) if isinstance(source.schema["MODIFIED_TS"].dataType, T.StringType) else None
    if known is not None:
        increment = without_known(increment, "MODIFIED_TS", known)
    stamped = add_ingest_columns(increment, cfg.source_table, cfg.source_system, wm, run_ts)
    modified = typed_ts(increment, "MODIFIED_TS")
    stamped, obs = with_run_metrics(stamped, "extract", max_ts=F.max(micros(modified)), unparsed=F.count_if(modified.isNull()))
    # Sorted within each task (no shuffle): Parquet row-group min/max stats on
    # MODIFIED_TS then let later time-bounded scans skip row groups.
    append_bronze(stamped.sortWithinPartitions("MODIFIED_TS"), cfg.bronze_master, run_ts)
    m = obs.get
    if not m["rows"]:
        log.info("no rows after watermark %s; bronze and watermark unchanged", wm)
        return {"rows": 0, "watermark": wm, "written": False}
    reached = from_micros(m["max_ts"]) or wm
    if m["unparsed"]:
        mine = read_ingested(spark, cfg.bronze_master, run_ts).filter(F.col("_ingestion_ts") == F.lit(ingestion_text(run_ts)))
        new = quarantine_rows(mine, "MODIFIED_TS", source.columns, cfg.source_table, run_ts)
        new.write.mode("append").parquet(cfg.quarantine)
    while True:
        reached = max(reached, wm)
        try:
            put_watermark(spark, cfg.watermarks, cfg.source_table, reached, m["rows"], run_ts, expected=seq)
            break
        except CommitConflict:
            wm, seq = watermark_state(spark, cfg.watermarks, cfg.source_table, cfg.first_watermark)
    return {"rows": m["rows"], "unparsed": m["unparsed"], "watermark": reached, "written": True}


def run_silver_master(spark: SparkSession, cfg: LakeConfig, run_ts: dt.datetime | None = None) -> dict:
    """Rebuild silver from all of bronze; the pointer written last makes it the current master."""
    bronze = read_bronze_master(spark, cfg.bronze_master)
    newest = F.max(micros(typed_ts(bronze, "_ingestion_ts", K.MODIFIED_TS_FORMAT)))
    bronze, obs_in = with_run_metrics(bronze, "silver_master_in", high_water=newest)
    silver, obs_out = with_run_metrics(silver_loan_master(bronze, _now(run_ts)), "silver_master_out")
    overwrite_table(silver, cfg.silver_master, ["loan_type"])
    rows_in, rows_out = obs_in.get["rows"], obs_out.get["rows"]
    high_water = from_micros(obs_in.get["high_water"])
    publish_version(spark, cfg.versions, SILVER_MASTER_TABLE, None, cfg.silver_master, high_water)
    return {"rows_in": rows_in, "rows_out": rows_out, "duplicates_removed": rows_in - rows_out}


SILVER_MASTER_TABLE = "silver_loan_master"
SILVER_EVENTS_TABLE = "silver_loan_events"
# Which of the two layouts of the event facts was written last: by event type (rebuild) or by date (refresh).
GOLD_EVENTS_TABLE = "gold_events"


def run_silver_master_incremental(spark: SparkSession, cfg: LakeConfig, run_ts: dt.datetime | None = None, attempts: int = 5) -> dict:
    """Merge new bronze rows into a new silver version; merged anew if another writer published one meanwhile."""
    for _ in range(attempts - 1):
        try:
            return merge_silver_master(spark, cfg, run_ts)
        except CommitConflict as e:
            log.info("%s; merging again", e)
    return merge_silver_master(spark, cfg, run_ts)


def merge_silver_master(spark: SparkSession, cfg: LakeConfig, run_ts: dt.datetime | None = None) -> dict:
    """Merge only bronze rows ingested since the last merge into a new silver version.

    Bronze directories are pruned by ingestion date (``PartitionFilters`` on
    year/month/day), rows by ingestion time (``>=`` the last merged one:
    re-merging a row is idempotent).  The current version is read, never
    overwritten; the new version's pointer is appended after its data.
    """
    run_ts = _now(run_ts)
    info = version_info(spark, cfg.versions, SILVER_MASTER_TABLE)
    bronze = read_bronze_master(spark, cfg.bronze_master)
    typed = normalize_loan_master(bronze)
    if info is not None and info["high_water"] is not None:
        hw = info["high_water"]
        ingest_date = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))
        keep = (ingest_date >= F.to_date(instant(hw))) & (typed_ts(bronze, "_ingestion_ts", K.MODIFIED_TS_FORMAT) >= instant(hw))
        typed = normalize_loan_master(bronze.filter(keep))
    increment, obs = with_run_metrics(add_silver_lineage(typed, K.JOB_SILVER_MASTER, run_ts), "silver_master_increment",
                                     high_water=F.max(micros(F.col("_ingestion_ts"))))
    if info is None:
        merged = latest_per_key(increment, MASTER_KEYS, master_order())
        version = 0
    else:
        current = spark.read.parquet(info["path"]).select(*increment.columns)
        merged = merge_latest(current, increment, MASTER_KEYS, MASTER_RANK)
        version = info["version"] + 1
    merged, obs_out = with_run_metrics(merged, "silver_master_rows")
    path = write_version(merged, cfg.silver_master_versions, version, ["loan_type"])
    m = obs.get
    high_water = m["high_water"] if m["rows"] else to_micros(info["high_water"]) if info and info["high_water"] else None
    publish_version(spark, cfg.versions, SILVER_MASTER_TABLE, version, path, from_micros(high_water), expected=info and info["version"])
    return {"version": version, "rows_merged": m["rows"], "rows_out": obs_out.get["rows"], "path": path}


def current_silver_master(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """Silver master as last published, by a merge or by a full refresh, whichever came later.

    Before the batch pipeline has ever run there is no master: an empty one
    with the silver schema is returned, so the events pipeline still runs
    (every event is then unmatched) instead of depending on job order.
    """
    info = version_info(spark, cfg.versions, SILVER_MASTER_TABLE)
    try:
        return read_table(spark, info["path"] if info else cfg.silver_master)
    except AnalysisException as e:
        if not is_missing(e):
            raise
        empty = spark.createDataFrame([], T.StructType([T.StructField(n, t) for n, t in SILVER_LOAN_MASTER_COLUMNS]))
        return add_silver_lineage(empty, K.JOB_SILVER_MASTER)


def run_gold_master(
    spark: SparkSession,
    cfg: LakeConfig,
    as_of: dt.date | str | None = None,
    run_ts: dt.datetime | None = None,
    silver: DataFrame | None = None,
) -> dict:
    run_ts = _now(run_ts)
    silver = silver if silver is not None else current_silver_master(spark, cfg)
    overwrite_table(dim_status(spark, run_ts, with_lineage=True), cfg.gold_table("dim_status"))
    overwrite_table(dim_loan_type(spark, run_ts, with_lineage=True), cfg.gold_table("dim_loan_type"))
    fact = fact_loan_performance(silver, dim_loan_type(spark), dim_status(spark), as_of, run_ts, K.JOB_GOLD_MASTER)
    fact, obs = with_run_metrics(fact, "fact_loan_performance")
    overwrite_table(fact, cfg.gold_table("fact_loan_performance"), ["occ_classification"])
    return {"fact_loan_performance": obs.get["rows"]}


def run_silver_events(spark: SparkSession, cfg: LakeConfig, run_ts: dt.datetime | None = None) -> dict:
    bronze, obs_in = with_run_metrics(read_bronze_events(spark, cfg.bronze_events), "silver_events_in")
    silver, obs_out = with_run_metrics(silver_loan_events(bronze, _now(run_ts)), "silver_events_out")
    overwrite_table(silver, cfg.silver_events, ["event_type"])
    rows_in, rows_out = obs_in.get["rows"], obs_out.get["rows"]
    publish_version(spark, cfg.versions, SILVER_EVENTS_TABLE, None, cfg.silver_events)
    return {"rows_in": rows_in, "rows_out": rows_out, "duplicates_removed": rows_in - rows_out}


def run_gold_events(
    spark: SparkSession, cfg: LakeConfig, run_ts: dt.datetime | None = None, silver_events: DataFrame | None = None
) -> dict:
    """Activity fact, then the summary from the activity table just written (not recomputed)."""
    run_ts = _now(run_ts)
    events = silver_events if silver_events is not None else read_table(spark, cfg.silver_events)
    activity = fact_loan_event_activity(
        events, current_silver_master(spark, cfg), dim_loan_type(spark), dim_status(spark), run_ts, K.JOB_GOLD_EVENTS
    )
    activity, obs_a = with_run_metrics(activity, "fact_loan_event_activity")
    overwrite_table(activity, cfg.gold_table("fact_loan_event_activity"), ["event_type"])
    summary = event_summary(read_table(spark, cfg.gold_table("fact_loan_event_activity")), run_ts, K.JOB_GOLD_EVENTS)
    summary, obs_s = with_run_metrics(summary, "fact_event_summary")
    overwrite_table(summary, cfg.gold_table("fact_event_summary"), ["event_type"])
    _publish_gold_events(spark, cfg, "fact_loan_event_activity")
    return {"fact_loan_event_activity": obs_a.get["rows"], "fact_event_summary": obs_s.get["rows"]}


GOLD_ACTIVITY_BY_DATE = "fact_loan_event_activity_by_date"
GOLD_SUMMARY_BY_MONTH = "fact_event_summary_by_month"
_HW_EVENTS = "gold_events.silver_events"
_HW_DATES = "gold_events.silver_event_dates"
_HW_MASTER = "gold_events.silver_master"


def _publish_gold_events(spark: SparkSession, cfg: LakeConfig, table: str) -> None:
    publish_version(spark, cfg.versions, GOLD_EVENTS_TABLE, None, cfg.gold_table(table))


def gold_event_tables(spark: SparkSession, cfg: LakeConfig) -> dict[str, tuple[str, tuple[str, ...]]]:
    """Location and partition columns of the event facts that were written last."""
    info = version_info(spark, cfg.versions, GOLD_EVENTS_TABLE)
    if info is not None and info["path"] == cfg.gold_table(GOLD_ACTIVITY_BY_DATE):
        return {
            "fact_loan_event_activity": (cfg.gold_table(GOLD_ACTIVITY_BY_DATE), ("event_date",)),
            "fact_event_summary": (cfg.gold_table(GOLD_SUMMARY_BY_MONTH), ("event_year", "event_month")),
        }
    return {t: (cfg.gold_table(t), ("event_type",)) for t in ("fact_loan_event_activity", "fact_event_summary")}


# What the event fact takes from a loan's master row.
_FACT_ATTRIBUTES = ["loan_id", "loan_type", "principal", "interest_rate", "term_months", "status", "branch_id", "origination_dt"]


def _changed_loans(spark: SparkSession, master: DataFrame, now: dict | None, seen: dict | None) -> DataFrame | None:
    """Loans whose attributes differ between the master last used and the present one; None if it is the same version.

    Versions are compared, not time stamps, so two merges within one second or
    with one ``run_ts`` count as two.  A master rewritten in place since
    then (full refresh) has no old state to compare: all its loans count.
    """
    if (now and now["version"]) == (seen and seen["version"]) and (now is None) == (seen is None):
        return None
    rows = master.select(*_FACT_ATTRIBUTES)
    if seen is None or now is None or seen["path"] == now["path"]:
        return rows.select("loan_id")
    try:
        old = read_table(spark, seen["path"]).select(*_FACT_ATTRIBUTES)
    except AnalysisException as e:
        if not is_missing(e):
            raise
        return rows.select("loan_id")
    marked = rows.withColumn("_side", F.lit(1)).unionByName(old.withColumn("_side", F.lit(-1)))
    return marked.groupBy(*_FACT_ATTRIBUTES).agg(F.sum("_side").alias("_n")).filter("_n <> 0").select("loan_id").distinct()


def _dates_filter(dates: list) -> Column:
    known = [d for d in dates if d is not None]
    cond = F.col("event_date").isin(known) if known else F.lit(False)
    return cond | F.col("event_date").isNull() if len(known) < len(dates) else cond


def run_gold_events_incremental(
    spark: SparkSession,
    cfg: LakeConfig,
    run_ts: dt.datetime | None = None,
    silver_events: DataFrame | None = None,
    changes: DataFrame | None = None,
) -> dict:
    """Refresh the event facts for the dates whose inputs changed since the last refresh.

    The activity fact is stored by ``event_date`` and the summary by
    (``event_year``, ``event_month``), its own grouping keys, so a date's
    activity depends only on that date's events and a month's summary only on
    that month's activity.  A date is stale when silver events of that date
    were (re)written since the last refresh, or when it holds an event of a
    loan whose silver master row was (re)written since then (the fact carries
    the loan's *current* attributes).

    Changed event dates come from ``changes`` (``event_date, seq``), the manifest
    of the incremental silver events, so no events scan is needed; without it
    every date is stale once silver events were rewritten.  Changed loans come
    from comparing the master version used last with the present one; only if
    there are any are their events' dates looked up (a column-pruned semi
    join).  The stale dates (a set bounded by the calendar) are fetched, and
    only those activity partitions and the months containing them are
    recomputed and replaced (dynamic partition overwrite).  What was seen is
    published after the data, so a failed run is simply redone.  The result
    equals a full rebuild.
    """
    run_ts = _now(run_ts)
    events = silver_events if silver_events is not None else read_table(spark, cfg.silver_events)
    if "event_date" not in events.columns:
        events = events.withColumn("event_date", F.to_date("event_ts"))
    # What is seen is fixed first: changes that land while this run works are left for the next one.
    seen = {t: version_info(spark, cfg.versions, t) for t in (_HW_EVENTS, _HW_DATES, _HW_MASTER)}
    now = {_HW_MASTER: version_info(spark, cfg.versions, SILVER_MASTER_TABLE)}
    master = current_silver_master(spark, cfg)
    if changes is not None:
        upto = changes.agg(F.max("seq")).first()[0]
        now[_HW_DATES] = None if upto is None else {"version": upto, "path": cfg.silver_event_dates}
        after = seen[_HW_DATES]["version"] if seen[_HW_DATES] else -1
        stale = changes.filter((F.col("seq") > after) & (F.col("seq") <= (-1 if upto is None else upto))).select("event_date")
    else:
        now[_HW_EVENTS] = version_info(spark, cfg.versions, SILVER_EVENTS_TABLE)
        same = now[_HW_EVENTS] and seen[_HW_EVENTS] and now[_HW_EVENTS]["version"] == seen[_HW_EVENTS]["version"]
        stale = events.select("event_date").filter(F.lit(not same))
    changed = _changed_loans(spark, master, now[_HW_MASTER], seen[_HW_MASTER])
    if changed is not None:
        stale = stale.unionByName(events.select("loan_id", "event_date").join(changed, "loan_id", "left_semi").select("event_date"))
    dates = [r.event_date for r in stale.distinct().collect()]
    out = {"stale_dates": len(dates), "fact_loan_event_activity": 0, "fact_event_summary": 0}
    if dates:
        activity = fact_loan_event_activity(
            events.filter(_dates_filter(dates)), master, dim_loan_type(spark), dim_status(spark), run_ts,
            K.JOB_GOLD_EVENTS,
        )
        activity, obs_a = with_run_metrics(activity, "activity_refreshed")
        activity_path = cfg.gold_table(GOLD_ACTIVITY_BY_DATE)
        (rebalanced(activity, ["event_date"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("event_date").parquet(activity_path))
        months = {(d.year, d.month) if d is not None else (None, None) for d in dates}
        month_cond = None
        for y, m in months:
            c = (F.col("event_year").isNull() if y is None
                 else (F.col("event_year") == F.lit(y)) & (F.col("event_month") == F.lit(m)))
            month_cond = c if month_cond is None else month_cond | c
        # Read back the written activity of the stale months (partition pruning
        # on event_date via the calendar parts), not recomputed.
        first = [dt.date(y, m, 1) for y, m in months if y is not None]
        date_cond = F.lit(False)
        for d in first:
            nxt = dt.date(d.year + (d.month == 12), d.month % 12 + 1, 1)
            date_cond = date_cond | ((F.col("event_date") >= F.lit(d)) & (F.col("event_date") < F.lit(nxt)))
        if (None, None) in months:
            date_cond = date_cond | F.col("event_date").isNull()
        month_activity = read_table(spark, activity_path).filter(date_cond & month_cond)
        summary, obs_s = with_run_metrics(event_summary(month_activity, run_ts, K.JOB_GOLD_EVENTS), "summary_refreshed")
        (summary.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("event_year", "event_month").parquet(cfg.gold_table(GOLD_SUMMARY_BY_MONTH)))
        out.update(fact_loan_event_activity=obs_a.get["rows"], fact_event_summary=obs_s.get["rows"])
    for table, state in now.items():
        if state is not None and (seen[table] is None or seen[table]["version"] != state["version"]):
            publish_version(spark, cfg.versions, table, state["version"], state["path"])
    if dates:
        _publish_gold_events(spark, cfg, GOLD_ACTIVITY_BY_DATE)
    return out


def gold_event_totals(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """Per-event-type totals read back from the written summary (for display)."""
    return event_type_totals(read_table(spark, gold_event_tables(spark, cfg)["fact_event_summary"][0]))


def register_all(spark: SparkSession, cfg: LakeConfig) -> None:
    """Register the gold tables that exist; the event facts' names show the layout written last."""
    tables = {
        "fact_loan_performance": (cfg.gold_table("fact_loan_performance"), ("occ_classification",)),
        "dim_status": (cfg.gold_table("dim_status"), ()),
        "dim_loan_type": (cfg.gold_table("dim_loan_type"), ()),
        **gold_event_tables(spark, cfg),
        GOLD_ACTIVITY_BY_DATE: (cfg.gold_table(GOLD_ACTIVITY_BY_DATE), ("event_date",)),
        GOLD_SUMMARY_BY_MONTH: (cfg.gold_table(GOLD_SUMMARY_BY_MONTH), ("event_year", "event_month")),
    }
    for name, (path, parts) in tables.items():
        try:
            repoint_table(spark, cfg.db, name, path, parts)
        except AnalysisException as e:
            if not is_missing(e):  # not built yet by the other pipeline
                raise


def run_batch_pipeline(
    spark: SparkSession,
    source: DataFrame,
    cfg: LakeConfig,
    as_of: dt.date | str | None = None,
    run_ts: dt.datetime | None = None,
    incremental_silver: bool = False,
) -> dict:
    """Watermark check -> incremental extract -> silver master -> gold master -> catalog.

    ``incremental_silver`` merges only newly ingested bronze into a new silver
    version instead of rebuilding silver from all of bronze.
    """
    run_ts = _now(run_ts)
    status = watermark_status(spark, cfg.watermarks, cfg.source_table).first().asDict()
    log.info("watermark state: %s", status)
    out = {"watermark_before": status}
    out["extract"] = run_extract(spark, source, cfg, run_ts)
    if incremental_silver:
        out["silver"] = run_silver_master_incremental(spark, cfg, run_ts)
        silver_path = out["silver"]["path"]
    else:
        out["silver"] = run_silver_master(spark, cfg, run_ts)
        silver_path = cfg.silver_master
    out["gold"] = run_gold_master(spark, cfg, as_of, run_ts, silver=read_table(spark, silver_path))
    register_all(spark, cfg)
    repoint_table(spark, cfg.db, "silver_loan_master", silver_path, ("loan_type",))
    return out


def run_events_pipeline(spark: SparkSession, cfg: LakeConfig, run_ts: dt.datetime | None = None) -> dict:
    """Silver events -> gold activity + summary -> catalog."""
    run_ts = _now(run_ts)
    out = {"silver": run_silver_events(spark, cfg, run_ts), "gold": run_gold_events(spark, cfg, run_ts)}
    register_all(spark, cfg)
    return out
