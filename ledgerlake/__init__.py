"""ledgerlake: a Spark-native loan lakehouse (bronze -> silver -> gold).

Public API (all transforms are lazy DataFrame -> DataFrame functions):
"""

from ledgerlake.operators.dedup import latest_per_key, merge_latest
from ledgerlake.operators.facts import fact_loan_event_activity, fact_loan_performance
from ledgerlake.operators.lineage import add_gold_lineage, add_ingest_columns, add_silver_lineage
from ledgerlake.operators.metrics import dedup_metrics, with_run_metrics
from ledgerlake.operators.normalize import normalize_loan_events, normalize_loan_master
from ledgerlake.operators.scd2 import lead_within_key, loan_master_scd2
from ledgerlake.operators.summary import event_summary, event_type_totals
from ledgerlake.plans.analytics import delinquency_by_type, risk_by_occ, volume_by_event_type
from ledgerlake.plans.config import LakeConfig
from ledgerlake.plans.layers import silver_loan_events, silver_loan_master
from ledgerlake.plans.pipelines import (
    run_batch_pipeline,
    run_events_pipeline,
    run_extract,
    run_silver_master_incremental,
)
from ledgerlake.sources.dims import dim_loan_type, dim_status
from ledgerlake.sources.incremental import read_incremental
from ledgerlake.sources.watermark import get_watermark, next_watermark, put_watermark, watermark_status
from ledgerlake.streaming.dedup import dedup_stream
from ledgerlake.streaming.ingest import start_bronze_stream
from ledgerlake.streaming.refresh import refresh_gold_events, refresh_silver_events

__all__ = [
    "LakeConfig", "add_gold_lineage", "add_ingest_columns", "add_silver_lineage", "dedup_metrics", "dedup_stream",
    "delinquency_by_type", "dim_loan_type", "dim_status", "event_summary", "event_type_totals",
    "fact_loan_event_activity", "fact_loan_performance", "get_watermark", "latest_per_key", "lead_within_key",
    "loan_master_scd2", "merge_latest", "next_watermark", "normalize_loan_events", "normalize_loan_master",
    "put_watermark", "read_incremental", "refresh_gold_events", "refresh_silver_events", "risk_by_occ",
    "run_batch_pipeline", "run_events_pipeline", "run_extract", "run_silver_master_incremental",
    "silver_loan_events", "silver_loan_master", "start_bronze_stream", "volume_by_event_type",
    "watermark_status", "with_run_metrics",
]
