from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake.operators.dedup import MASTER_KEYS, MASTER_RANK, merge_latest
from ledgerlake.operators.normalize import normalize_loan_events, normalize_loan_master
from ledgerlake.plans.layers import silver_loan_events, silver_loan_master

MASTER_TEXT = (
    "loan_id string, customer_id string, loan_type string, origination_dt string, principal string, "
    "interest_rate string, term_months string, status string, branch_id string, MODIFIED_TS string, _ingestion_ts string"
)


def _master(spark, rows):
    return spark.createDataFrame(rows, MASTER_TEXT)


def test_malformed_master_values_become_null(spark):
    df = _master(spark, [("L1", "C1", "AUTO", "2024-13-01", "abc", "x", "y", "CURRENT", "BR1", "xx", "zz")])
    row = normalize_loan_master(df).first()
    assert row.origination_dt is None
    assert row.principal is None and row.interest_rate is None and row.term_months is None
    assert row.MODIFIED_TS is None and row._ingestion_ts is None
    assert row.loan_id == "L1"


def test_overflowing_principal_is_null(spark):
    df = _master(spark, [("L1", "C1", "AUTO", "2024-01-01", "99999999999999999", "3.5", "60", "CURRENT", "BR1",
                          "2024-01-01 00:00:00", "2024-01-02 00:00:00")])
    row = normalize_loan_master(df).first()
    assert row.principal is None
    assert row.interest_rate == Decimal("3.5000")


def test_master_accepts_double_input_and_keeps_only_silver_columns(spark):
    df = spark.createDataFrame(
        [("L1", 123.45, 60, "2024-01-01 00:00:00", "2024-01-02 00:00:00", 2024, "x")],
        "loan_id string, principal double, term_months bigint, MODIFIED_TS string, _ingestion_ts string, year int, _pod_name string",
    )
    out = normalize_loan_master(df)
    assert "year" not in out.columns and "_pod_name" not in out.columns
    row = out.first()
    assert row.principal == Decimal("123.4500") and row.term_months == 60
    assert row.loan_type is None  # missing input column -> NULL


def test_master_dedup_tie_is_deterministic(spark):
    a = ("L1", "C1", "AUTO", "2024-01-01", "1", "1", "60", "CURRENT", "BR1", "2024-02-01 00:00:00", "2024-03-01 00:00:00")
    b = ("L1", "C1", "AUTO", "2024-01-01", "2", "1", "60", "DEFAULT", "BR1", "2024-02-01 00:00:00", "2024-03-02 00:00:00")
    for rows in ([a, b], [b, a]):
        out = silver_loan_master(_master(spark, rows).repartition(3)).collect()
        assert len(out) == 1 and out[0].status == "DEFAULT"


def test_newer_version_wins_over_later_ingestion(spark):
    old = ("L1", "C1", "AUTO", "2024-01-01", "1", "1", "60", "CURRENT", "BR1", "2024-02-01 00:00:00", "2024-09-01 00:00:00")
    new = ("L1", "C1", "AUTO", "2024-01-01", "1", "1", "60", "PAID_OFF", "BR1", "2024-03-01 00:00:00", "2024-04-01 00:00:00")
    assert silver_loan_master(_master(spark, [old, new])).first().status == "PAID_OFF"


EVENTS = (
    "loan_id string, customer_id string, event_type string, amount double, currency string, account_number string, "
    "event_ts string, _ingestion_ts string, _partition long, _offset long"
)


def test_redelivery_keeps_highest_offset(spark):
    ev = ("L1", "C1", "PAYMENT", 10.0, "USD", "A", "2024-01-01T00:00:01+00:00", "2024-01-01T00:00:01+00:00", 1)
    df = spark.createDataFrame([ev + (5,), ev + (9,)], EVENTS)
    out = silver_loan_events(df).collect()
    assert len(out) == 1 and out[0]._offset == 9


def test_events_iso_offsets_parse_to_utc_and_optional_fields(spark):
    ev = ("L1", "C1", "PAYMENT", 10.0, "USD", "A", "2024-01-01T05:00:00+02:00", "2024-01-01T05:00:00+02:00", 1, 1)
    row = normalize_loan_events(spark.createDataFrame([ev], EVENTS)).first()
    assert row.event_ts == dt.datetime(2024, 1, 1, 3, 0, 0)
    assert row.loan_type is None and row.status is None
    assert row.amount == Decimal("10.0000")


def test_silver_is_idempotent(spark):
    from ledgerlake import fixtures as X

    bronze = X.bronze_loan_master(spark, "/root/testdata/sf0.001")
    once = silver_loan_master(bronze, X.RUN_TS)
    twice = silver_loan_master(bronze.unionByName(bronze), X.RUN_TS)
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def test_merge_latest_equals_full_rebuild_with_null_keys(spark):
    rows = [
        ("L1", "C1", "AUTO", "2024-01-01", "1", "1", "60", "CURRENT", "BR1", "2024-02-01 00:00:00", "2024-03-01 00:00:00"),
        ("L1", "C1", "AUTO", "2024-01-01", "1", "1", "60", "DEFAULT", "BR1", "2024-05-01 00:00:00", "2024-06-01 00:00:00"),
        ("L2", "C2", "AUTO", "2024-01-01", "1", "1", "60", "CURRENT", "BR1", "2024-02-01 00:00:00", "2024-03-01 00:00:00"),
        (None, "C3", "AUTO", "2024-01-01", "1", "1", "60", "CURRENT", "BR1", "2024-02-01 00:00:00", "2024-03-01 00:00:00"),
        (None, "C4", "AUTO", "2024-01-01", "1", "1", "60", "DEFAULT", "BR1", "2024-06-01 00:00:00", "2024-07-01 00:00:00"),
    ]
    typed = normalize_loan_master(_master(spark, rows))
    cut = F.lit("2024-04-01 00:00:00").cast("timestamp")
    current = silver_loan_master(typed.filter(F.col("MODIFIED_TS") <= cut), "2024-08-01 00:00:00")
    inc = silver_loan_master(typed.filter(F.col("MODIFIED_TS") > cut), "2024-08-01 00:00:00")
    merged = merge_latest(current, inc, MASTER_KEYS, MASTER_RANK)
    full = silver_loan_master(typed, "2024-08-01 00:00:00")
    assert merged.count() == full.count() == 3
    assert merged.exceptAll(full).isEmpty()
