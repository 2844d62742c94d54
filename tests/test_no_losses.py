"""What must not be lost or changed: long keys, odd times, restarts, time zones, crashes, equal stamps, NULL keys, large sums."""

from __future__ import annotations

import datetime as dt
import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from ledgerlake import fixtures as X
from ledgerlake.operators.facts import fact_loan_event_activity
from ledgerlake.operators.scd2 import loan_master_scd2
from ledgerlake.operators.summary import event_summary, event_type_totals
from ledgerlake.plans.config import LakeConfig
from ledgerlake.plans.layers import silver_loan_events, silver_loan_master
from ledgerlake.plans.pipelines import run_batch_pipeline, run_extract, run_silver_master, run_silver_master_incremental
from ledgerlake.sinks.files import append_bronze
from ledgerlake.sources.bronze import read_bronze_master
from ledgerlake.sources.dims import dim_loan_type, dim_status

SF = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _source(spark):
    return X.bronze_loan_master(spark, SF).drop("_ingestion_ts")


def test_keys_are_padded_and_never_cut(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet").limit(200)
    big = orders.withColumn("o_orderkey", F.col("o_orderkey") + F.lit(15_000_000)).withColumn("o_custkey", F.col("o_custkey") + F.lit(1_000_000))
    both = orders.unionByName(big)
    loans = spark.sql(X.BRONZE_LOAN_MASTER_SQL, orders=both)
    assert loans.select("loan_id").distinct().count() == both.select("o_orderkey").distinct().count()
    assert loans.select("customer_id").distinct().count() == both.select("o_custkey").distinct().count()
    events = spark.read.parquet(f"{SF}/events.parquet").limit(400).withColumn("user_id", F.col("user_id") + F.lit(9_500_000))
    made = spark.sql(X.BRONZE_LOAN_EVENTS_SQL, events=events)
    assert made.filter("loan_id like 'X%'").count() > 0 and made.filter("loan_id like 'L9%'").select("loan_id").distinct().count() > 0


def test_extract_keeps_fractions_and_times_that_do_not_parse(spark, lake):
    cfg = LakeConfig(root=lake, first_watermark="0001-01-01 00:00:00")
    src = _source(spark)
    assert run_extract(spark, src, cfg, dt.datetime(2024, 1, 1, 1))["rows"] == src.count()  # no default start that drops rows
    odd = src.limit(3).withColumn("loan_id", F.concat(F.lit("Z"), F.monotonically_increasing_id().cast("string")))
    times = ["2024-01-01 16:30:00.5", "xx", "2024-01-01T16:30:00.25+00:00"]
    rows = [odd.limit(1).withColumn("MODIFIED_TS", F.lit(t)).withColumn("loan_id", F.lit(f"Z{k}")) for k, t in enumerate(times)]
    out = run_extract(spark, src.unionByName(rows[0]).unionByName(rows[1]).unionByName(rows[2]), cfg, dt.datetime(2024, 1, 2, 1))
    assert out["rows"] == 3 and out["unparsed"] == 1 and out["watermark"] == dt.datetime(2024, 1, 1, 16, 30, 0, 500_000)
    silver = {r.loan_id: r.MODIFIED_TS for r in silver_loan_master(read_bronze_master(spark, cfg.bronze_master)).filter("loan_id like 'Z%'").collect()}
    assert set(silver) == {"Z0", "Z1", "Z2"} and silver["Z1"] is None and silver["Z0"] is not None


def _run(code: str, tz: str = "UTC", **conf: str) -> str:
    settings = "".join(f".config({k!r}, {v!r})" for k, v in {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", **conf}.items())
    head = f"import sys; sys.path.insert(0, {REPO!r})\nfrom pyspark.sql import SparkSession\nspark = SparkSession.builder.master('local[2]'){settings}.getOrCreate()\n"
    done = subprocess.run([sys.executable, "-c", head + code], env=os.environ | {"TZ": tz}, cwd="/tmp", capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    return done.stdout


@pytest.mark.parametrize("named", [False, True])
def test_ingest_goes_on_where_another_process_stopped(tmp_path, named):
    topic = tmp_path / "topic"
    topic.mkdir()
    conf = {"spark.sql.warehouse.dir": str(tmp_path / "wh")} | ({"spark.checkpoint.dir": str(tmp_path / "ck")} if named else {})
    for k in range(2):
        with open(topic / f"{k}.json", "w") as f:
            for i in range(10):
                event = {"loan_id": f"L{i}", "customer_id": "C", "event_type": "PAYMENT", "amount": 1.0, "event_ts": f"2024-01-0{k + 1}T00:00:0{i}+00:00", "_ingestion_ts": "2024-01-03T00:00:00+00:00"}
                f.write(json.dumps({"value": json.dumps(event), "partition": 0, "offset": 10 * k + i}) + "\n")
        root = str(tmp_path / "lake")
        out = _run(
            "from ledgerlake import cli\n"
            f"cli.main(['ingest', '--root', {root!r}, '--source-dir', {str(topic)!r}, '--available-now'])\n"
            f"cli.main(['refresh', '--root', {root!r}, '--db', 'two'])\n"
            f"print('ROWS', spark.read.json({root!r} + '/bronze/loan_events').count())",
            **conf,
        )
        assert f"ROWS {10 * (k + 1)}" in out
        assert json.loads(next(line for line in out.splitlines() if line.startswith("{")))["stale_dates"] == 1


@pytest.mark.parametrize("tz", ["Asia/Tokyo", "America/New_York"])
def test_watermarks_do_not_depend_on_the_drivers_time_zone(tmp_path, tz):
    code = f"""
import datetime as dt
from ledgerlake.session import prepare_session
from ledgerlake.plans.config import LakeConfig
from ledgerlake.plans.pipelines import run_extract, run_silver_master_incremental
from ledgerlake.sinks.files import version_info
prepare_session(spark)
cfg = LakeConfig(root={str(tmp_path)!r})
def state(n):
    return spark.createDataFrame([(f'L{{h}}', f'2024-01-01 {{h:02d}}:00:00') for h in range(n)], 'loan_id string, MODIFIED_TS string')
a = run_extract(spark, state(13), cfg, dt.datetime(2024, 1, 1, 23, 30))
m = run_silver_master_incremental(spark, cfg, dt.datetime(2024, 1, 1, 23, 30))
b = run_extract(spark, state(24), cfg, dt.datetime(2024, 1, 2, 0, 30))
n = run_silver_master_incremental(spark, cfg, dt.datetime(2024, 1, 2, 0, 30))
print('GOT', a['rows'], a['watermark'], b['rows'], b['watermark'], m['rows_out'], n['rows_out'], version_info(spark, cfg.versions, 'silver_loan_master')['high_water'])
"""
    want = "GOT 13 2024-01-01 12:00:00 11 2024-01-01 23:00:00 13 24 2024-01-02 00:30:00"
    assert want in _run(code, tz, **{"spark.sql.warehouse.dir": str(tmp_path / "wh")})


def test_a_crash_before_the_manifest_loses_nothing(spark, lake, monkeypatch):
    from ledgerlake.streaming import refresh as R

    cfg = LakeConfig(root=lake, db="crash_lake")
    bronze = X.bronze_loan_events(spark, SF)
    half = F.col("_offset") % 2 == 0  # every date is in both halves
    append_bronze(bronze.filter(half), cfg.bronze_events, "2024-01-01 01:00:00", with_hour=True, fmt="json")
    R.refresh_silver_events(spark, cfg, X.RUN_TS).awaitTermination()
    append_bronze(bronze.filter(~half), cfg.bronze_events, "2024-01-01 02:00:00", with_hour=True, fmt="json")
    real = R.silver_event_dates
    calls = []

    def fails_after_the_data(spark_, cfg_):
        calls.append(1)
        if len(calls) == 2:  # first: what is there; second: right before the manifest's rows
            raise RuntimeError("lost the driver")
        return real(spark_, cfg_)

    monkeypatch.setattr(R, "silver_event_dates", fails_after_the_data)
    with pytest.raises(Exception, match="lost the driver"):
        R.refresh_silver_events(spark, cfg, X.RUN_TS).awaitTermination()
    monkeypatch.undo()
    R.refresh_silver_events(spark, cfg, X.RUN_TS).awaitTermination()
    want = silver_loan_events(bronze, X.RUN_TS)
    got = R.current_silver_events(spark, cfg).select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_report_after_refresh_and_equal_run_stamps(spark, lake):
    from ledgerlake.plans import analytics as A
    from ledgerlake.plans.pipelines import current_silver_master, register_all
    from ledgerlake.streaming.refresh import current_silver_events, refresh_gold_events

    cfg, stamp = LakeConfig(root=lake, db="one_gold"), dt.datetime(2024, 2, 1)
    src = _source(spark)
    run_batch_pipeline(spark, src, cfg, as_of=X.AS_OF, run_ts=stamp, incremental_silver=True)
    append_bronze(X.bronze_loan_events(spark, SF), cfg.bronze_events, "2024-01-01 01:00:00", with_hour=True, fmt="json")
    refresh_gold_events(spark, cfg, stamp, incremental=True)
    register_all(spark, cfg)

    def rebuilt():
        events = current_silver_events(spark, cfg).drop("event_date")
        return A.volume_by_type(fact_loan_event_activity(events, current_silver_master(spark, cfg), dim_loan_type(spark), dim_status(spark)))

    assert A.volume_by_event_type(spark, cfg.db).collect() == rebuilt().collect()
    # a merge with the very same run stamp that changes every loan makes its events' dates stale
    changed = src.dropDuplicates(["loan_id"]).withColumn("status", F.lit("CHARGED_OFF")).withColumn("MODIFIED_TS", F.lit("2002-01-01 00:00:00"))
    run_batch_pipeline(spark, changed, cfg, as_of=X.AS_OF, run_ts=stamp, incremental_silver=True)
    assert refresh_gold_events(spark, cfg, stamp, incremental=True)["stale_dates"] > 0
    shown = spark.table(f"{cfg.db}.fact_loan_event_activity").filter("current_status is not null")
    assert [r.current_status for r in shown.select("current_status").distinct().collect()] == ["CHARGED_OFF"]
    # a full refresh after a merge is the newer master
    run_silver_master(spark, cfg, stamp)
    assert current_silver_master(spark, cfg).inputFiles()[0].startswith(f"file://{cfg.silver_master}/")
    run_silver_master_incremental(spark, cfg, stamp)
    assert cfg.silver_master_versions in current_silver_master(spark, cfg).inputFiles()[0]


def _largest_share(df) -> float:
    sizes = [r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    return max(sizes) / (sum(sizes) / len(sizes))


def test_null_keys_and_null_times_are_spread(spark):
    events = silver_loan_events(X.bronze_loan_events(spark, SF), X.RUN_TS)
    bare = events.withColumn("loan_id", F.when(F.col("_offset") % 10 == 0, F.col("loan_id")))
    bare = bare.unionByName(bare.filter("loan_id is null").withColumn("_offset", F.col("_offset") + 5_000_000))
    master = silver_loan_master(X.bronze_loan_master(spark, SF), X.RUN_TS)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], "1000")
        spark.conf.set(keys[1], "false")
        fact = fact_loan_event_activity(bare, master, dim_loan_type(spark), dim_status(spark))
        assert fact.count() == bare.count() and fact.filter("loan_id is null and loan_type is not null").isEmpty()
        assert _largest_share(fact) < 2
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    # copies of a version without a time: reduced before they are sent to the loan's task
    bronze = X.bronze_loan_master(spark, SF)
    pile = bronze.limit(1).withColumn("MODIFIED_TS", F.lit("never")).crossJoin(spark.range(5000)).drop("id")
    hist = loan_master_scd2(bronze.unionByName(pile), max_group_rows=100)
    plain = loan_master_scd2(bronze.unionByName(pile))
    assert hist.exceptAll(plain).isEmpty() and hist.count() == plain.count()
    plan = hist._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_sums_beyond_eighteen_digits(spark):
    from ledgerlake.plans import analytics as A

    base = fact_loan_event_activity(
        silver_loan_events(X.bronze_loan_events(spark, SF), X.RUN_TS), silver_loan_master(X.bronze_loan_master(spark, SF), X.RUN_TS), dim_loan_type(spark), dim_status(spark)
    )
    large = base.limit(1).withColumn("amount", F.lit("90000000000000.0000").cast("decimal(18,4)")).crossJoin(spark.range(30)).drop("id")
    summary = event_summary(large, X.RUN_TS)
    assert summary.first().total_amount == event_type_totals(summary).first().total_volume == 27 * 10**14
    assert A.volume_by_type(large).first().total_volume == 27 * 10**14
