from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlake import fixtures as X
from ledgerlake.operators.scd2 import lead_within_key, loan_master_scd2

SF = "/root/testdata/sf0.001"


def _brute_force(bronze_pdf: pd.DataFrame) -> set[tuple]:
    """Reference semantics in plain pandas: dedup (loan, ts) by latest ingestion, then lead per loan."""
    df = bronze_pdf.copy()
    df["valid_from"] = pd.to_datetime(df["MODIFIED_TS"])
    df["ing"] = pd.to_datetime(df["_ingestion_ts"])
    df = df.sort_values(["loan_id", "valid_from", "ing"]).drop_duplicates(["loan_id", "valid_from"], keep="last")
    df = df.sort_values(["loan_id", "valid_from"])
    df["valid_to"] = df.groupby("loan_id")["valid_from"].shift(-1)
    return {
        (r.loan_id, r.status, r.valid_from.to_pydatetime(), None if pd.isna(r.valid_to) else r.valid_to.to_pydatetime())
        for r in df.itertuples()
    }


@pytest.mark.parametrize("max_group_rows", [1, 2, 1_000_000])
def test_scd2_matches_brute_force_including_hot_key_splits(spark, max_group_rows):
    bronze = X.bronze_loan_master(spark, SF)
    # Make one loan hot: many versions of the same loan at distinct times.
    hot = spark.sql(
        "select 'L0000001' as loan_id, 'C00001' as customer_id, 'AUTO' as loan_type, '1996-01-01' as origination_dt, "
        "cast(1000 + id as double) as principal, cast(3.0 as double) as interest_rate, cast(60 as bigint) as term_months, "
        "case when id % 2 = 0 then 'CURRENT' else 'DEFAULT' end as status, 'BR001' as branch_id, "
        "cast(timestamp'1997-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id * 7 + (id % 5)) as string) as MODIFIED_TS, "
        "'2001-09-01 00:00:00' as _ingestion_ts from range(200)"
    )
    bronze = bronze.unionByName(hot).unionByName(hot.limit(20))  # exact re-extractions too
    out = loan_master_scd2(bronze, max_group_rows=max_group_rows)
    got = {(r.loan_id, r.status, r.valid_from, r.valid_to) for r in out.collect()}
    assert got == _brute_force(bronze.toPandas())
    assert out.filter("is_current").count() == out.select("loan_id").distinct().count()


def test_lead_within_key_handles_null_times(spark):
    df = spark.createDataFrame(
        [("a", None), ("a", "2024-01-01 00:00:00"), ("a", "2024-01-02 00:00:00"), ("a", "2024-01-03 00:00:00"),
         ("b", "2024-01-01 00:00:00")],
        "k string, t string",
    ).selectExpr("k", "cast(t as timestamp) as t")
    rows = lead_within_key(df, "k", "t", "nxt", max_group_rows=1).collect()
    got = sorted(((r.k, str(r.t), str(r.nxt)) for r in rows))
    assert got == [
        ("a", "2024-01-01 00:00:00", "2024-01-02 00:00:00"),
        ("a", "2024-01-02 00:00:00", "2024-01-03 00:00:00"),
        ("a", "2024-01-03 00:00:00", "None"),
        ("a", "None", "2024-01-01 00:00:00"),
        ("b", "2024-01-01 00:00:00", "None"),
    ]


def _clustered(spark):
    """One hot key: a version decades before a dense burst, plus a second burst; and two ordinary keys."""
    return spark.sql(
        "select 'hot' as k, timestamp'1990-01-01 00:00:00' as t "
        "union all select 'hot', timestamp'2024-03-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id) from range(2000) "
        "union all select 'hot', timestamp'2024-06-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id, 0) from range(500) "
        "union all select 'hot', cast(null as timestamp) "
        "union all select 'a', timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, id) from range(5) "
        "union all select 'b', cast(null as timestamp)"
    )


@pytest.mark.parametrize("broadcast_max_rows", [1_000_000, 0])
def test_hot_key_buckets_are_balanced_by_count_not_time(spark, broadcast_max_rows):
    from ledgerlake.operators.scd2 import with_time_buckets

    df = _clustered(spark)
    target = 100
    sizes = {
        (r.k, r._bucket): r.n
        for r in with_time_buckets(df, "k", "t", max_group_rows=target, broadcast_max_rows=broadcast_max_rows)
        .groupBy("k", "_bucket").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    hot = {b: n for (k, b), n in sizes.items() if k == "hot"}
    assert sum(hot.values()) == 2502
    assert max(n for b, n in hot.items() if b >= 0) <= 2 * target  # equal-width slices would put ~2000 in one
    assert hot[-1] == 1  # the NULL time
    assert sizes[("a", 0)] == 5 and sizes[("b", 0)] == 1

    got = {(r.k, r.t, r.nxt) for r in lead_within_key(df, "k", "t", "nxt", max_group_rows=target,
                                                        broadcast_max_rows=broadcast_max_rows).collect()}
    pdf = df.toPandas().sort_values(["k", "t"], na_position="first")
    pdf["nxt"] = pdf.groupby("k")["t"].shift(-1)
    want = {(r.k, None if pd.isna(r.t) else r.t.to_pydatetime(), None if pd.isna(r.nxt) else r.nxt.to_pydatetime())
            for r in pdf.itertuples()}
    assert got == want


def test_scd2_pile_of_copies_of_one_version_makes_one_version(spark):
    bronze = X.bronze_loan_master(spark, SF)
    one = bronze.filter("loan_id = 'L0000001'").orderBy("MODIFIED_TS").limit(1)
    # 400 re-extractions of the same version (same MODIFIED_TS, later ingestion times, another status).
    pile = one.crossJoin(spark.range(400)).selectExpr(
        *[c for c in bronze.columns if c not in ("status", "_ingestion_ts")],
        "'DEFAULT' as status",
        "cast(timestamp'2001-10-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id) as string) as _ingestion_ts",
    ).select(*bronze.columns)
    piled = bronze.unionByName(pile)
    out = loan_master_scd2(piled, max_group_rows=50)  # the loan is hot by its raw rows
    got = {(r.loan_id, r.status, r.valid_from, r.valid_to) for r in out.collect()}
    assert got == _brute_force(piled.toPandas())
    assert out.filter("loan_id = 'L0000001'").count() == bronze.filter("loan_id = 'L0000001'") \
        .select("MODIFIED_TS").distinct().count()
