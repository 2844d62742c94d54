from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake import fixtures as X
from ledgerlake.operators import history as H
from ledgerlake.operators.scd2 import SCD2_COLUMNS, loan_master_scd2
from ledgerlake.plans.config import LakeConfig
from ledgerlake.plans.history import current_history, run_history_incremental
from ledgerlake.plans.pipelines import run_extract

COLUMNS = "loan_id string, customer_id string, loan_type string, origination_dt string, principal double, interest_rate double, term_months long, status string, branch_id string, MODIFIED_TS string, _ingestion_ts string"
SF = "/root/testdata/sf0.001"


def rows_of(rng, n, run):
    out = []
    for _ in range(n):
        time = rng.choice([None, "never", *(f"2001-{m:02d}-01 00:00:00" for m in range(1, 13))])
        out.append((rng.choice(["L1", "L2", "L3", None]), "C1", "AUTO", "2000-01-01", 1.0, 2.5, 60, f"S{rng.randrange(1_000)}", "B1", time, f"2002-01-{run:02d} 00:00:00"))
    # one ingestion has one content per version
    seen = {}
    return [seen.setdefault((r[0], r[9]), r) for r in out]


@pytest.mark.parametrize("seed", [1, 2])
def test_increments_in_any_order_equal_one_build(spark, seed):
    rng = random.Random(seed)
    steps = [rows_of(rng, n, run) for run, n in ((1, 6), (2, 10), (3, 1), (4, 12))]
    # a copy from an older ingestion arrives last
    steps.append([(*steps[0][0][:7], "stale", *steps[0][0][8:10], "2001-12-31 00:00:00")])
    history, seen = None, []
    for rows in steps:
        seen += rows
        from ledgerlake.operators.normalize import normalize_loan_master

        typed = normalize_loan_master(spark.createDataFrame(rows, COLUMNS))
        if history is None:
            history = loan_master_scd2(spark.createDataFrame(rows, COLUMNS)).join(
                H.versions_of(typed).select(F.col("loan_id").alias("l"), F.col("valid_from").alias("v"), "_ingestion_ts"),
                F.col("loan_id").eqNullSafe(F.col("l")) & F.col("valid_from").eqNullSafe(F.col("v")),
            )
            history = history.select(*H.HISTORY_COLUMNS).checkpoint()
        else:
            history = H.merge_history(history, typed).checkpoint()
        want = loan_master_scd2(spark.createDataFrame(seen, COLUMNS))
        got = history.select(*SCD2_COLUMNS)
        assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_increments_leave_other_months_files_alone(spark, lake):
    cfg = LakeConfig(root=lake, db="hist", first_watermark="1900-01-01 00:00:00")
    source = X.bronze_loan_master(spark, SF).drop("_ingestion_ts")
    cut = F.lit("2001-07-15 00:00:00")
    run_extract(spark, source.filter(F.col("MODIFIED_TS") <= cut), cfg, dt.datetime(2024, 1, 1))
    first = run_history_incremental(spark, cfg, dt.datetime(2024, 1, 1))
    before = set(current_history(spark, cfg).inputFiles())
    run_extract(spark, source, cfg, dt.datetime(2024, 1, 2))
    out = run_history_incremental(spark, cfg, dt.datetime(2024, 1, 2))
    bronze = spark.read.parquet(cfg.bronze_master)
    want = loan_master_scd2(bronze)
    got = current_history(spark, cfg).select(*SCD2_COLUMNS)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    assert 0 < out["months"] < first["months"] and before & set(current_history(spark, cfg).inputFiles())
    # nothing new: nothing is written
    assert run_history_incremental(spark, cfg, dt.datetime(2024, 1, 3))["months"] == 0
    # one late version of one loan: its interval's month and its own
    late = source.limit(1).withColumn("MODIFIED_TS", F.lit("2002-02-02 00:00:00"))
    run_extract(spark, late, cfg, dt.datetime(2024, 1, 4))
    assert run_history_incremental(spark, cfg, dt.datetime(2024, 1, 4))["months"] <= 2
    got, want = current_history(spark, cfg).select(*SCD2_COLUMNS), loan_master_scd2(spark.read.parquet(cfg.bronze_master))
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_a_hot_loan_is_spread_over_its_days(spark):
    from ledgerlake.operators.normalize import normalize_loan_master

    def rows(times, run):
        base = spark.createDataFrame([("L1", t.strftime("%Y-%m-%d %H:%M:%S")) for t in times], "loan_id string, MODIFIED_TS string")
        columns = {"customer_id": "C", "loan_type": "AUTO", "origination_dt": "2000-01-01", "status": "S", "branch_id": "B", "_ingestion_ts": f"2030-01-{run:02d} 00:00:00"}
        return base.withColumns({**{k: F.lit(v) for k, v in columns.items()}, "principal": F.lit(1.0), "interest_rate": F.lit(1.0), "term_months": F.lit(6)})

    start = dt.datetime(2001, 1, 1)
    old = rows([start + dt.timedelta(hours=7 * k) for k in range(400)], 1)
    new = rows([start + dt.timedelta(hours=11 * k - 50) for k in range(300)], 2)
    versions = H.versions_of(normalize_loan_master(old))
    history = loan_master_scd2(old).withColumn("_ingestion_ts", F.lit("2030-01-01 00:00:00").cast("timestamp")).select(*H.HISTORY_COLUMNS)
    located = H.covering(H.versions_of(normalize_loan_master(new)), history)
    plan = located._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "rangepartitioning" not in plan
    assert "_at" not in [c for c in located.columns] and located.count() == 300 and versions.count() == 400
    got = H.merge_history(history, normalize_loan_master(new)).select(*SCD2_COLUMNS)
    want = loan_master_scd2(old.unionByName(new))
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
