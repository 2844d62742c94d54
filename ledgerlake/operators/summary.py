"""Event summary (8-key group) and per-event-type totals.

The summary has two exact distinct counts.  Spark plans them with an Expand
and a two-level aggregate: the first level groups by (keys, distinct value)
with map-side partial aggregation, so a hot group is spread over reducers by
its distinct values and pre-reduced before it is shuffled; the second level
only combines one row per (group, value).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import constants as K
from ledgerlake.operators.lineage import add_gold_lineage
from ledgerlake.schemas import DEC_AMOUNT, DEC_TOTAL, EVENT_SUMMARY_KEYS


def event_summary(activity: DataFrame, run_ts: dt.datetime | str | None = None, job: str = K.JOB_GOLD_EVENTS) -> DataFrame:
    df = activity.groupBy(*EVENT_SUMMARY_KEYS).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum("amount").cast(DEC_TOTAL).alias("total_amount"),
        F.avg("amount").cast(DEC_AMOUNT).alias("avg_amount"),
        F.countDistinct("loan_id").alias("distinct_loans"),
        F.countDistinct("customer_id").alias("distinct_customers"),
        F.min("event_ts").alias("first_event_ts"),
        F.max("event_ts").alias("last_event_ts"),
    )
    return add_gold_lineage(df, job, run_ts)


def event_type_totals(summary: DataFrame) -> DataFrame:
    """Re-aggregate the summary per event type, ordered by event type."""
    return (
        summary.groupBy("event_type")
        .agg(F.sum("event_count").alias("total_events"), F.sum("total_amount").alias("total_volume"))
        .orderBy("event_type")
    )
