"""Registered queries: one per operator group, each over the driver's tables.

Every callable takes ``(spark, sf_dir)``, derives bronze loan tables from the
whole ``orders`` / ``events`` tables (``ledgerlake.fixtures``) and returns a
DataFrame.  The queries that look for hot keys first run a sampled scan when
they are built (``_hot_loans``, ``loan_master_scd2``); the others are lazy.  Wall-clock inputs are fixed (``AS_OF``, ``RUN_TS``) so the
results are reproducible and comparable with the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import constants as K
from ledgerlake import fixtures as X
from ledgerlake.functions.instants import from_micros, to_micros
from ledgerlake.operators.dedup import EVENT_KEYS, MASTER_KEYS, MASTER_RANK, merge_latest
from ledgerlake.operators.facts import fact_loan_event_activity, fact_loan_performance
from ledgerlake.operators.history import HISTORY_COLUMNS, merge_history, versions_of
from ledgerlake.operators.incremental_summary import activity_measures, refresh_summary, signed_counts, signed_totals, summary_of_state
from ledgerlake.operators.lineage import add_ingest_columns, add_silver_lineage
from ledgerlake.operators.metrics import dedup_metrics
from ledgerlake.operators.normalize import normalize_loan_events, normalize_loan_master
from ledgerlake.operators.scd2 import SCD2_COLUMNS, loan_master_scd2
from ledgerlake.operators.skew import HotKeys, hot_key_salts
from ledgerlake.operators.summary import event_summary, event_type_totals
from ledgerlake.plans import analytics as A
from ledgerlake.plans.layers import silver_loan_events, silver_loan_master
from ledgerlake.session import checkpoint_dir
from ledgerlake.sources.dims import dim_loan_type, dim_status
from ledgerlake.sources.bounds import bounded_select
from ledgerlake.sources.incremental import read_incremental
from ledgerlake.sources.quarantine import quarantine_rows, without_known
from ledgerlake.sources.watermark import next_watermark_frame

Query = Callable[[SparkSession, str], DataFrame]


def _silver_master(spark: SparkSession, sf: str) -> DataFrame:
    return silver_loan_master(X.bronze_loan_master(spark, sf), X.RUN_TS)


def _silver_events(spark: SparkSession, sf: str) -> DataFrame:
    return silver_loan_events(X.bronze_loan_events(spark, sf), X.RUN_TS)


def _extract_source(spark: SparkSession, sf: str) -> DataFrame:
    # The source table carries no ingestion stamp; extraction adds it.
    return X.bronze_loan_master(spark, sf).drop("_ingestion_ts")


def q_master_normalized(spark: SparkSession, sf: str) -> DataFrame:
    return normalize_loan_master(X.bronze_loan_master(spark, sf))


def q_incremental_extract(spark: SparkSession, sf: str) -> DataFrame:
    inc = read_incremental(_extract_source(spark, sf), "MODIFIED_TS", X.INCREMENT_WATERMARK)
    return add_ingest_columns(inc, watermark=X.INCREMENT_WATERMARK, run_ts=X.RUN_TS)


def q_next_watermark(spark: SparkSession, sf: str) -> DataFrame:
    inc = read_incremental(_extract_source(spark, sf), "MODIFIED_TS", X.INCREMENT_WATERMARK)
    return next_watermark_frame(inc, "MODIFIED_TS")


def q_extract_bounded(spark: SparkSession, sf: str) -> DataFrame:
    """The source applies its own bound on text times; the typed filter takes the rest."""
    source = X.source_loan_master(spark, sf)
    bounded = spark.sql(bounded_select("{src}", "MODIFIED_TS", X.INCREMENT_WATERMARK), src=source)
    return read_incremental(bounded, "MODIFIED_TS", X.INCREMENT_WATERMARK)


def q_extract_quarantined(spark: SparkSession, sf: str) -> DataFrame:
    """An extraction after another one that saw the loans without a later version: rows of unreadable time taken then are not taken again."""
    source = X.source_loan_master(spark, sf)
    seen = source.filter(F.col("origination_dt") <= X.INCREMENT_WATERMARK[:10])
    known = quarantine_rows(seen, "MODIFIED_TS", source.columns, K.SOURCE_TABLE, from_micros(to_micros(X.RUN_TS)))
    return without_known(read_incremental(source, "MODIFIED_TS", X.INCREMENT_WATERMARK), "MODIFIED_TS", known)


def q_loan_master_silver(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_master(spark, sf)


def q_events_normalized(spark: SparkSession, sf: str) -> DataFrame:
    return normalize_loan_events(X.bronze_loan_events(spark, sf))


def q_loan_events_silver(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_events(spark, sf)


def q_dedup_metrics(spark: SparkSession, sf: str) -> DataFrame:
    bm, be = X.bronze_loan_master(spark, sf), X.bronze_loan_events(spark, sf)
    return dedup_metrics(
        {
            "loan_master": (normalize_loan_master(bm), MASTER_KEYS),
            "loan_events": (normalize_loan_events(be), EVENT_KEYS),
        }
    )


def q_fact_loan_performance(spark: SparkSession, sf: str) -> DataFrame:
    return fact_loan_performance(
        _silver_master(spark, sf), dim_loan_type(spark), dim_status(spark), as_of=X.AS_OF, run_ts=X.RUN_TS
    )


_HOT_LOANS: dict[tuple[str, str], HotKeys] = {}


def _hot_loans(spark: SparkSession, sf: str) -> HotKeys:
    """Hot loans of a table, estimated once in an application.

    Counted on bronze events (a sampled scan, an upper bound of silver rows per
    loan), not on silver, which would run the dedup shuffle twice.  The estimate
    only decides how rows are spread, so it need not be repeated per query.
    """
    at = (spark.sparkContext.applicationId, sf)
    if at not in _HOT_LOANS:
        _HOT_LOANS[at] = HotKeys(hot_key_salts(X.bronze_loan_events(spark, sf), "loan_id"))
    return _HOT_LOANS[at]


def q_fact_loan_event_activity(spark: SparkSession, sf: str) -> DataFrame:
    return fact_loan_event_activity(
        _silver_events(spark, sf), _silver_master(spark, sf), dim_loan_type(spark), dim_status(spark), run_ts=X.RUN_TS,
        hot_loans=_hot_loans(spark, sf),
    )


def q_fact_event_summary(spark: SparkSession, sf: str) -> DataFrame:
    return event_summary(q_fact_loan_event_activity(spark, sf), run_ts=X.RUN_TS)


def q_event_summary_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The summary of the events and master up to the watermark, brought up to date by what changed since, equals the full one."""
    wm = F.lit(X.INCREMENT_WATERMARK).cast("timestamp")
    events, dims = _silver_events(spark, sf), (dim_loan_type(spark), dim_status(spark))
    typed = normalize_loan_master(X.bronze_loan_master(spark, sf))
    changed = typed.filter(F.col("MODIFIED_TS") > wm).select("loan_id").distinct()
    old_master = silver_loan_master(X.bronze_loan_master(spark, sf).filter(F.col("MODIFIED_TS") <= X.INCREMENT_WATERMARK), X.RUN_TS)
    hot = _hot_loans(spark, sf)
    before = fact_loan_event_activity(events.filter(F.col("event_ts") <= wm), old_master, *dims, run_ts=X.RUN_TS, hot_loans=hot)
    after = fact_loan_event_activity(events, _silver_master(spark, sf), *dims, run_ts=X.RUN_TS, hot_loans=hot)
    # What a job would have written, and reads more than once, is checkpointed.
    checkpoint_dir(spark)
    before = activity_measures(before).checkpoint()
    again = changed.withColumn("_again", F.lit(True))
    came = activity_measures(after.join(again, "loan_id", "left").filter((F.col("event_ts") > wm) | F.col("_again")))
    went = before.join(changed, "loan_id", "left_semi")
    changes = came.withColumn("sign", F.lit(1)).unionByName(went.select(*came.columns).withColumn("sign", F.lit(-1))).checkpoint()
    first = before.withColumn("sign", F.lit(1))
    totals, counts = signed_totals(first), signed_counts(first)
    d_totals, d_counts = signed_totals(changes).checkpoint(), signed_counts(changes).checkpoint()
    return refresh_summary(summary_of_state(totals, counts, X.RUN_TS), totals, counts, d_totals, d_counts, X.RUN_TS)[0]


def q_event_type_totals(spark: SparkSession, sf: str) -> DataFrame:
    return event_type_totals(q_fact_event_summary(spark, sf))


def q_risk_by_occ(spark: SparkSession, sf: str) -> DataFrame:
    return A.exposure_by_class(q_fact_loan_performance(spark, sf))


def q_volume_by_event_type(spark: SparkSession, sf: str) -> DataFrame:
    return A.volume_by_type(q_fact_loan_event_activity(spark, sf))


def q_delinquency_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return A.delinquency_by_loan_type(q_fact_loan_performance(spark, sf))


def q_merge_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Silver built in two steps (up to the watermark, then the increment) equals a full rebuild."""
    typed = normalize_loan_master(X.bronze_loan_master(spark, sf))
    wm = F.lit(X.INCREMENT_WATERMARK).cast("timestamp")
    older = typed.filter(F.col("MODIFIED_TS").isNull() | (F.col("MODIFIED_TS") <= wm))
    increment = typed.filter(F.col("MODIFIED_TS") > wm)
    current = silver_loan_master(older, X.RUN_TS)
    inc = add_silver_lineage(increment, K.JOB_SILVER_MASTER, X.RUN_TS)
    return merge_latest(current, inc, MASTER_KEYS, MASTER_RANK)


def q_loan_master_scd2(spark: SparkSession, sf: str) -> DataFrame:
    return loan_master_scd2(X.bronze_loan_master(spark, sf))


def q_scd2_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The loan history in three increments, the second one late: equal to one build."""
    bronze = X.bronze_loan_master(spark, sf)
    early, late = F.col("MODIFIED_TS") <= "2000-12-31 00:00:00", F.col("MODIFIED_TS") > X.INCREMENT_WATERMARK
    known = F.coalesce(early | late, F.lit(False))
    checkpoint_dir(spark)
    empty = versions_of(normalize_loan_master(bronze)).withColumns({"valid_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True)})
    history = empty.select(*HISTORY_COLUMNS).limit(0)
    for part in (bronze.filter(late), bronze.filter(early), bronze.filter(~known)):
        # A job would have written the history and read it again.
        history = merge_history(history, normalize_loan_master(part)).checkpoint()
    return history.select(*SCD2_COLUMNS)


QUERIES: dict[str, Query] = {
    "fact_loan_performance": q_fact_loan_performance,
    "master_normalized": q_master_normalized,
    "incremental_extract": q_incremental_extract,
    "next_watermark": q_next_watermark,
    "loan_master_silver": q_loan_master_silver,
    "events_normalized": q_events_normalized,
    "loan_events_silver": q_loan_events_silver,
    "dedup_metrics": q_dedup_metrics,
    "fact_loan_event_activity": q_fact_loan_event_activity,
    "fact_event_summary": q_fact_event_summary,
    "event_type_totals": q_event_type_totals,
    "risk_by_occ": q_risk_by_occ,
    "volume_by_event_type": q_volume_by_event_type,
    "delinquency_by_type": q_delinquency_by_type,
    "merge_latest": q_merge_latest,
    "loan_master_scd2": q_loan_master_scd2,
    "scd2_incremental": q_scd2_incremental,
    "extract_bounded": q_extract_bounded,
    "extract_quarantined": q_extract_quarantined,
    "event_summary_incremental": q_event_summary_incremental,
}
