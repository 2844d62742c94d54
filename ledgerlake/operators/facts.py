"""Gold facts: credit-risk performance per loan and enriched event activity.

Join strategy.  The two dimensions are inline ``VALUES`` relations of a few
rows with exact size statistics, so the planner broadcasts them by its
normal size check and the fact never shuffles for them.  The events ⟕
master join is left to the planner and AQE: it is a sort-merge join on
``loan_id`` that AQE turns into a broadcast join when the shuffled master
side measures under the runtime threshold, and whose skewed ``loan_id``
partitions AQE splits on the (left, streamed) events side.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import constants as K
from ledgerlake import functions as LF
from ledgerlake.operators.skew import HotKeys, salted_left_join, spread_left_join
from ledgerlake.schemas import FACT_LOAN_EVENT_ACTIVITY_COLUMNS, FACT_LOAN_PERFORMANCE_COLUMNS


def fact_loan_performance(
    silver_master: DataFrame,
    dim_loan_type: DataFrame,
    dim_status: DataFrame,
    as_of: dt.date | str | None = None,
    run_ts: dt.datetime | str | None = None,
    job: str = K.JOB_GOLD_MASTER,
) -> DataFrame:
    """One row per loan with OCC class, balance, delinquency and risk-weighted exposure.

    ``as_of`` is the report date (default: today).  Unknown status or type
    gives NULL keys, ``is_delinquent = false`` and a NULL exposure.
    """
    report_dt = F.current_date() if as_of is None else LF.as_date(as_of)
    lt = dim_loan_type.select("loan_type_key", "loan_type")
    st = dim_status.select("status_key", "status", "occ_classification", "loss_given_default")
    joined = silver_master.join(lt, "loan_type", "left").join(st, "status", "left")
    balance = LF.estimated_balance(F.col("status"), F.col("principal"))
    # One projection (not a chain of withColumn calls, each re-analysing the plan).
    derived = {
        "report_dt": report_dt,
        "months_remaining": LF.months_remaining(F.col("term_months"), F.col("origination_dt"), report_dt),
        "estimated_balance": balance,
        "is_delinquent": LF.is_delinquent(F.col("status")),
        "risk_weighted_exposure": LF.risk_weighted_exposure(balance, F.col("loss_given_default")),
        "_gold_job": F.lit(job),
        "_gold_ts": F.current_timestamp() if run_ts is None else LF.as_timestamp(run_ts),
    }
    return joined.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in FACT_LOAN_PERFORMANCE_COLUMNS])


def fact_loan_event_activity(
    silver_events: DataFrame,
    silver_master: DataFrame,
    dim_loan_type: DataFrame,
    dim_status: DataFrame,
    run_ts: dt.datetime | str | None = None,
    job: str = K.JOB_GOLD_EVENTS,
    hot_loans: HotKeys | None = None,
) -> DataFrame:
    """One row per silver event, enriched with the loan's current master attributes.

    The event's own ``loan_type``/``status`` are dropped before the join:
    loan type and status always come from master (no ambiguous columns).
    Events with no matching loan keep NULL loan attributes.

    ``hot_loans`` (see ``operators.skew``) salts the events ⟕ master join for
    loans with very many events.  Pass it when the inputs are computed in
    the same plan (master partitioned by its own dedup, where AQE cannot
    split a skewed join); over written silver tables AQE's skew join
    splits hot loans by itself.
    """
    events = silver_events.select(
        "loan_id", "customer_id", "event_type", "event_ts", "amount", "currency", "_partition", "_offset"
    )
    master = silver_master.select(
        "loan_id", "loan_type", "principal", "interest_rate", "term_months",
        F.col("status").alias("current_status"), "branch_id", "origination_dt",
    )
    lt = dim_loan_type.select("loan_type_key", "loan_type", "category", "collateral_type")
    st = dim_status.select("status_key", F.col("status").alias("current_status"), "occ_classification")
    spread_by = ["event_ts", "event_type", "_partition", "_offset"]
    if hot_loans is None:
        enriched = spread_left_join(events, master, "loan_id", spread_by)
    else:
        enriched = salted_left_join(events, master, "loan_id", hot_loans, spread_by)
    joined = enriched.join(lt, "loan_type", "left").join(st, "current_status", "left")
    derived = {
        "event_date": F.to_date("event_ts"),
        "event_year": F.year("event_ts"),
        "event_month": F.month("event_ts"),
        "is_adverse": LF.is_adverse(F.col("event_type")),
        "payment_flag": LF.payment_flag(F.col("event_type")),
        "_gold_job": F.lit(job),
        "_gold_ts": F.current_timestamp() if run_ts is None else LF.as_timestamp(run_ts),
    }
    return joined.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in FACT_LOAN_EVENT_ACTIVITY_COLUMNS])
