"""Explicit schemas for every layer.

Bronze schemas are read schemas (no inference: inference costs a full pass
and fails on an empty directory).  Bronze numeric columns are declared as
strings-or-doubles by the writer; silver accepts either and casts safely.
"""

from __future__ import annotations

from pyspark.sql import types as T

DEC_AMOUNT = T.DecimalType(18, 4)
# Sums over any number of amounts.
DEC_TOTAL = T.DecimalType(38, 4)
DEC_RATE = T.DecimalType(8, 4)
DEC_LGD = T.DecimalType(5, 4)

# -- bronze --------------------------------------------------------------

BRONZE_LOAN_MASTER = T.StructType(
    [
        T.StructField("loan_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("loan_type", T.StringType()),
        T.StructField("origination_dt", T.StringType()),
        T.StructField("principal", T.DoubleType()),
        T.StructField("interest_rate", T.DoubleType()),
        T.StructField("term_months", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("branch_id", T.StringType()),
        T.StructField("MODIFIED_TS", T.StringType()),
        T.StructField("_source_table", T.StringType()),
        T.StructField("_source_system", T.StringType()),
        T.StructField("_ingestion_ts", T.StringType()),
        T.StructField("_watermark_start", T.StringType()),
    ]
)

BRONZE_LOAN_EVENTS = T.StructType(
    [
        T.StructField("loan_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("loan_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("account_number", T.StringType()),
        T.StructField("event_ts", T.StringType()),
        T.StructField("_ingestion_ts", T.StringType()),
        T.StructField("_source_topic", T.StringType()),
        T.StructField("_producer_version", T.StringType()),
        T.StructField("_partition", T.LongType()),
        T.StructField("_offset", T.LongType()),
        T.StructField("_ingest_worker", T.StringType()),
    ]
)

# The event payload as produced on the topic (before consumer metadata).
EVENT_PAYLOAD = T.StructType(
    [f for f in BRONZE_LOAN_EVENTS.fields if f.name not in ("_partition", "_offset", "_ingest_worker")]
)

# -- silver --------------------------------------------------------------

SILVER_LOAN_MASTER_COLUMNS = [
    ("loan_id", T.StringType()),
    ("customer_id", T.StringType()),
    ("loan_type", T.StringType()),
    ("origination_dt", T.DateType()),
    ("principal", DEC_AMOUNT),
    ("interest_rate", DEC_RATE),
    ("term_months", T.IntegerType()),
    ("status", T.StringType()),
    ("branch_id", T.StringType()),
    ("MODIFIED_TS", T.TimestampType()),
    ("_ingestion_ts", T.TimestampType()),
]

SILVER_LOAN_EVENTS_COLUMNS = [
    ("loan_id", T.StringType()),
    ("customer_id", T.StringType()),
    ("event_type", T.StringType()),
    ("amount", DEC_AMOUNT),
    ("currency", T.StringType()),
    ("loan_type", T.StringType()),
    ("status", T.StringType()),
    ("account_number", T.StringType()),
    ("event_ts", T.TimestampType()),
    ("_ingestion_ts", T.TimestampType()),
    ("_partition", T.IntegerType()),
    ("_offset", T.LongType()),
]

# -- dimensions ----------------------------------------------------------

DIM_STATUS = T.StructType(
    [
        T.StructField("status_key", T.IntegerType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("occ_classification", T.StringType(), False),
        T.StructField("loss_given_default", DEC_LGD, False),
        T.StructField("description", T.StringType(), True),
    ]
)

DIM_LOAN_TYPE = T.StructType(
    [
        T.StructField("loan_type_key", T.IntegerType(), False),
        T.StructField("loan_type", T.StringType(), False),
        T.StructField("category", T.StringType(), False),
        T.StructField("collateral_type", T.StringType(), False),
        T.StructField("real_estate_flag", T.BooleanType(), False),
    ]
)

# -- watermark state -------------------------------------------------------

WATERMARK_STATE = T.StructType(
    [
        T.StructField("source_table", T.StringType(), False),
        T.StructField("last_watermark", T.TimestampType()),
        T.StructField("last_run_ts", T.TimestampType()),
        T.StructField("last_row_count", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)

# -- source rows whose modification time does not parse ---------------------

QUARANTINE = T.StructType(
    [
        T.StructField("source_table", T.StringType()),
        T.StructField("row_hash", T.StringType()),
        T.StructField("time_text", T.StringType()),
        T.StructField("row_json", T.StringType()),
        T.StructField("first_seen", T.TimestampType()),
    ]
)

# -- gold column orders (fixed: the source platform's gold tables have these columns in this order) ----

FACT_LOAN_PERFORMANCE_COLUMNS = [
    "loan_id", "customer_id", "loan_type_key", "status_key",
    "loan_type", "status", "occ_classification",
    "origination_dt", "report_dt", "principal", "estimated_balance",
    "interest_rate", "term_months", "months_remaining",
    "is_delinquent", "loss_given_default", "risk_weighted_exposure",
    "branch_id", "MODIFIED_TS", "_gold_job", "_gold_ts",
]

FACT_LOAN_EVENT_ACTIVITY_COLUMNS = [
    "loan_id", "customer_id", "event_type",
    "event_ts", "event_date", "event_year", "event_month",
    "amount", "currency",
    "loan_type_key", "loan_type", "category", "collateral_type",
    "status_key", "current_status", "occ_classification",
    "principal", "interest_rate", "term_months",
    "branch_id", "origination_dt",
    "is_adverse", "payment_flag",
    "_partition", "_offset", "_gold_job", "_gold_ts",
]

EVENT_SUMMARY_KEYS = [
    "event_type", "loan_type_key", "loan_type", "status_key",
    "branch_id", "event_year", "event_month", "is_adverse",
]
