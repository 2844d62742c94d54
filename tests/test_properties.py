"""Property tests (few examples each: every example runs Spark jobs)."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlake.operators.dedup import MASTER_KEYS, MASTER_RANK, merge_latest
from ledgerlake.operators.normalize import normalize_loan_master
from ledgerlake.operators.scd2 import lead_within_key
from ledgerlake.plans.layers import silver_loan_master

MASTER = (
    "loan_id string, customer_id string, loan_type string, origination_dt string, principal string, "
    "interest_rate string, term_months string, status string, branch_id string, MODIFIED_TS string, _ingestion_ts string"
)
STATUSES = ["CURRENT", "DELINQUENT", "DEFAULT", "PAID_OFF", "CHARGED_OFF"]

row = st.tuples(
    st.integers(0, 5),  # loan
    st.integers(0, 20),  # modification day
    st.integers(0, 3),  # ingestion day
    st.sampled_from(STATUSES),
)
SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def _frame(spark, rows):
    out = []
    for loan, mod, ing, status in rows:
        out.append(
            (f"L{loan:07d}", "C1", "AUTO", "2020-01-01", "100.00", "3.0", "60", status, "BR001",
             (dt.datetime(2021, 1, 1) + dt.timedelta(days=mod)).strftime("%Y-%m-%d %H:%M:%S"),
             (dt.datetime(2022, 1, 1) + dt.timedelta(days=ing)).strftime("%Y-%m-%d %H:%M:%S"))
        )
    return spark.createDataFrame(out, MASTER)


def _set(df):
    return sorted(map(tuple, df.drop("_silver_ts").collect()), key=str)


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=40), cut=st.integers(0, 21))
def test_merge_equals_full_rebuild_and_silver_is_idempotent(spark, rows, cut):
    # Distinct (loan, time, ingestion) so the dedup order is total.
    rows = list({(r[0], r[1], r[2]): r for r in rows}.values())
    df = _frame(spark, rows)
    typed = normalize_loan_master(df)
    boundary = dt.datetime(2021, 1, 1) + dt.timedelta(days=cut)
    older = typed.filter(typed.MODIFIED_TS < boundary)
    newer = typed.filter(typed.MODIFIED_TS >= boundary)
    run = "2024-01-01 00:00:00"
    merged = merge_latest(silver_loan_master(older, run), silver_loan_master(newer, run), MASTER_KEYS, MASTER_RANK)
    full = silver_loan_master(typed, run)
    assert _set(merged) == _set(full)
    assert _set(silver_loan_master(df.unionByName(df), run)) == _set(full)


@SETTINGS
@given(
    keys=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 500)), min_size=1, max_size=60, unique=True),
    max_group_rows=st.integers(1, 8),
)
def test_skew_safe_lead_equals_plain_lead(spark, keys, max_group_rows):
    pdf = pd.DataFrame(
        {"k": [f"k{k}" for k, _ in keys], "t": [dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m) for _, m in keys]}
    )
    df = spark.createDataFrame(pdf, "k string, t timestamp")
    got = {(r.k, r.t, r.nxt) for r in lead_within_key(df, "k", "t", "nxt", max_group_rows=max_group_rows).collect()}
    pdf = pdf.sort_values(["k", "t"])
    pdf["nxt"] = pdf.groupby("k")["t"].shift(-1)
    want = {(r.k, r.t.to_pydatetime(), None if pd.isna(r.nxt) else r.nxt.to_pydatetime()) for r in pdf.itertuples()}
    assert got == want


@SETTINGS
@given(
    left=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 50)), min_size=1, max_size=80),
    right=st.lists(st.integers(0, 6), max_size=8, unique=True),
    max_group_rows=st.integers(1, 6),
)
def test_salted_left_join_equals_plain_left_join(spark, left, right, max_group_rows):
    from ledgerlake.operators.skew import HotKeys, hot_key_salts, salted_left_join

    l = spark.createDataFrame([(None if k is None else f"k{k}", v) for k, v in left], "k string, v int")
    r = spark.createDataFrame([(f"k{k}", k * 10) for k in right], "k string, w int")
    hot = HotKeys(hot_key_salts(l, "k", max_group_rows=max_group_rows))
    def rows(df):
        return sorted((tuple(x) for x in df.select("k", "v", "w").collect()),
                      key=lambda t: tuple((x is None, "" if x is None else x) for x in t))

    got, want = rows(salted_left_join(l, r, "k", hot, ["v"])), rows(l.join(r, "k", "left"))
    assert got == want
