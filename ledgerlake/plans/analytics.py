"""Reports over the gold tables, as aggregates of a DataFrame or of a catalog table.

Totals are DECIMAL(38,2): no group's sum overflows.  Only the output columns are
given from outside; ties in the sort column are broken by the group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY_TOTAL = T.DecimalType(38, 2)
PERCENT = T.DecimalType(5, 2)


def _report(facts: DataFrame, group: str, sort: str, **measures) -> DataFrame:
    report = facts.groupBy(group).agg(*[c.alias(name) for name, c in measures.items()])
    return report.orderBy(F.col(sort).desc_nulls_last(), F.col(group).asc_nulls_last())


def exposure_by_class(performance: DataFrame) -> DataFrame:
    """Loans and risk-weighted exposure of each OCC class."""
    exposure = F.sum("risk_weighted_exposure").cast(MONEY_TOTAL)
    return _report(performance, "occ_classification", "total_risk_exposure", loan_count=F.count(F.lit(1)), total_risk_exposure=exposure)


def volume_by_type(activity: DataFrame) -> DataFrame:
    """Events and their amounts of each event type."""
    volume = F.sum("amount").cast(MONEY_TOTAL)
    return _report(activity, "event_type", "event_count", event_count=F.count(F.lit(1)), total_volume=volume)


def delinquency_by_loan_type(performance: DataFrame) -> DataFrame:
    """Loans, delinquent loans and their share in percent, by loan type."""
    loans, late = F.count(F.lit(1)), F.count_if("is_delinquent")
    percent = (late.cast("decimal(20,0)") * 100 / loans.cast("decimal(20,0)")).cast(PERCENT)
    return _report(performance, "loan_type", "delinquency_rate", total_loans=loans, delinquent_loans=late, delinquency_rate=percent)


def risk_by_occ(spark: SparkSession, db: str) -> DataFrame:
    return exposure_by_class(spark.table(f"`{db}`.fact_loan_performance"))


def volume_by_event_type(spark: SparkSession, db: str) -> DataFrame:
    return volume_by_type(spark.table(f"`{db}`.fact_loan_event_activity"))


def delinquency_by_type(spark: SparkSession, db: str) -> DataFrame:
    return delinquency_by_loan_type(spark.table(f"`{db}`.fact_loan_performance"))
