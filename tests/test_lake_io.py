from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from ledgerlake import fixtures as X
from ledgerlake.plans import analytics as A
from ledgerlake.plans.config import LakeConfig
from ledgerlake.plans.pipelines import gold_event_totals, run_batch_pipeline, run_events_pipeline, run_extract
from ledgerlake.sinks.catalog import ddl_for, register_table
from ledgerlake.sinks.files import append_bronze, current_version, overwrite_table, publish_version, write_version
from ledgerlake.sources.bronze import read_bronze_events, read_bronze_master
from ledgerlake.sources.watermark import get_watermark, put_watermark, watermark_status

SF = "/root/testdata/sf0.001"


def _source(spark):
    return X.bronze_loan_master(spark, SF).drop("_ingestion_ts")


def _after_default_watermark(df):
    return df.filter(F.col("MODIFIED_TS") > F.lit("2000-01-01 00:00:00")).count()


def test_append_bronze_round_trip(spark, lake):
    df = _source(spark).limit(50)
    append_bronze(df, f"{lake}/b", "2024-03-05 07:08:09")
    assert os.path.isdir(f"{lake}/b/year=2024/month=03/day=05")
    back = read_bronze_master(spark, f"{lake}/b")
    assert back.count() == 50
    assert set(df.columns) <= set(back.columns)


def test_bronze_events_json_keeps_corrupt_lines(spark, lake):
    os.makedirs(f"{lake}/ev/year=2024/month=01/day=01/hour=00")
    with open(f"{lake}/ev/year=2024/month=01/day=01/hour=00/part.json", "w") as f:
        f.write('{"loan_id": "L1", "event_type": "PAYMENT", "amount": 1.5, "_offset": 3}\n')
        f.write('{"loan_id":\n')
    rows = read_bronze_events(spark, f"{lake}/ev").collect()
    good = [r for r in rows if r._corrupt_record is None]
    bad = [r for r in rows if r._corrupt_record is not None]
    assert len(good) == 1 and good[0].amount == 1.5 and good[0].year == 2024
    assert len(bad) == 1 and bad[0]._corrupt_record.startswith('{"loan_id"')


def test_watermark_state(spark, lake):
    path = f"{lake}/wm"
    assert get_watermark(spark, path) == dt.datetime(2000, 1, 1)
    assert watermark_status(spark, path).first().last_run == "Never"
    put_watermark(spark, path, "loan_master", dt.datetime(2001, 1, 1), 5, dt.datetime(2024, 1, 1))
    put_watermark(spark, path, "loan_master", dt.datetime(2001, 2, 1), 7, dt.datetime(2024, 1, 2))
    put_watermark(spark, path, "other", dt.datetime(1999, 1, 1), 1, dt.datetime(2024, 1, 3))
    assert get_watermark(spark, path) == dt.datetime(2001, 2, 1)
    st = watermark_status(spark, path).first()
    assert st.last_row_count == 7 and st.watermark.startswith("2001-02-01")


def test_extract_is_incremental_and_empty_increment_is_noop(spark, lake):
    cfg = LakeConfig(root=lake)
    src = _source(spark)
    first = run_extract(spark, src, cfg, dt.datetime(2024, 1, 1, 1))
    total = _after_default_watermark(src)
    assert 0 < first["rows"] == total < src.count()
    assert get_watermark(spark, cfg.watermarks) == first["watermark"]
    again = run_extract(spark, src, cfg, dt.datetime(2024, 1, 1, 2))
    assert again == {"rows": 0, "watermark": first["watermark"], "written": False}
    assert read_bronze_master(spark, cfg.bronze_master).count() == total


def test_crash_between_write_and_watermark_reextracts_and_silver_is_unchanged(spark, lake):
    cfg = LakeConfig(root=lake)
    src = _source(spark)
    # A crashed run: bronze written, watermark never advanced.
    from ledgerlake.operators.lineage import add_ingest_columns
    from ledgerlake.sources.incremental import read_incremental

    crashed = add_ingest_columns(read_incremental(src, "MODIFIED_TS", "2000-01-01 00:00:00"), run_ts="2024-01-01 00:00:00")
    append_bronze(crashed, cfg.bronze_master, "2024-01-01 00:00:00")
    out = run_batch_pipeline(spark, src, cfg, as_of=X.AS_OF, run_ts=dt.datetime(2024, 1, 2))
    assert out["extract"]["rows"] == _after_default_watermark(src)
    assert out["silver"]["duplicates_removed"] > 0
    clean = LakeConfig(root=f"{lake}/clean", db="clean_lake")
    run_batch_pipeline(spark, src, clean, as_of=X.AS_OF, run_ts=dt.datetime(2024, 1, 2))
    a = spark.read.parquet(cfg.silver_master).drop("_silver_ts")
    b = spark.read.parquet(clean.silver_master).drop("_silver_ts")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_pipelines_then_sql_over_catalog_twice(spark, lake):
    cfg = LakeConfig(root=lake, db="lake_twice")
    src = _source(spark)
    ev_bronze = X.bronze_loan_events(spark, SF)
    append_bronze(ev_bronze, cfg.bronze_events, "2024-01-01 05:00:00", with_hour=True, fmt="json")
    results = []
    for run in range(2):
        run_batch_pipeline(spark, src, cfg, as_of=X.AS_OF, run_ts=dt.datetime(2024, 1, 2, run))
        run_events_pipeline(spark, cfg, run_ts=dt.datetime(2024, 1, 2, run))
        results.append(
            (
                sorted(map(tuple, A.risk_by_occ(spark, cfg.db).collect()), key=str),
                sorted(map(tuple, A.volume_by_event_type(spark, cfg.db).collect()), key=str),
                sorted(map(tuple, A.delinquency_by_type(spark, cfg.db).collect()), key=str),
                [tuple(r) for r in gold_event_totals(spark, cfg).collect()],
            )
        )
    assert results[0] == results[1]
    # The report over the catalog equals the same report over the written files.
    fact = spark.read.parquet(cfg.gold_table("fact_loan_performance"))
    bound = A.exposure_by_class(fact)
    assert results[0][0] == sorted(map(tuple, bound.collect()), key=str)
    tables = {r.tableName for r in spark.sql(f"show tables in {cfg.db}").collect()}
    assert {"fact_loan_performance", "fact_loan_event_activity", "fact_event_summary", "dim_status", "dim_loan_type"} <= tables
    parts = spark.sql(f"show partitions {cfg.db}.fact_loan_performance").count()
    assert parts == 5  # four OCC classes and the NULL partition


def test_ddl_matches_written_schema(spark, lake):
    df = spark.sql("select 1 as a, cast(2.5 as decimal(18,4)) as b, 'x' as p")
    overwrite_table(df, f"{lake}/t", ["p"])
    text = ddl_for(spark.read.parquet(f"{lake}/t").schema, "db.t", f"{lake}/t", ("p",))
    assert "`b` decimal(18,4)" in text and "PARTITIONED BY (`p`)" in text
    table = register_table(spark, "ddl_db", "t", f"{lake}/t", ("p",))
    assert spark.table(table).columns == ["a", "b", "p"]
    assert spark.table(table).first().b == spark.read.parquet(f"{lake}/t").first().b


def test_versions_publish_after_data(spark, lake):
    control = f"{lake}/_control"
    assert current_version(spark, control, "t") is None
    p0 = write_version(spark.range(3), f"{lake}/t", 0)
    publish_version(spark, control, "t", 0, p0)
    p1 = write_version(spark.range(5), f"{lake}/t", 1)  # written but not published: a crash
    assert current_version(spark, control, "t") == (0, p0)
    publish_version(spark, control, "t", 1, p1)
    assert current_version(spark, control, "t") == (1, p1)
    assert current_version(spark, control, "t", before=1) == (0, p0)
    assert spark.read.parquet(current_version(spark, control, "t")[1]).count() == 5
    assert spark.read.parquet(p0).agg(F.max("id")).first()[0] == 2


def test_incremental_silver_master_equals_full_rebuild(spark, lake):
    from ledgerlake.plans.pipelines import current_silver_master, run_silver_master, run_silver_master_incremental

    cfg = LakeConfig(root=lake, db="inc_lake")
    src = _source(spark)
    steps = [
        src.filter(F.col("MODIFIED_TS") <= F.lit("2000-06-01 00:00:00")),
        src.filter(F.col("MODIFIED_TS") <= F.lit("2001-07-15 00:00:00")),
        src,
    ]
    extracted, merged = [], []
    for day, source_state in enumerate(steps, start=1):
        extracted.append(run_extract(spark, source_state, cfg, dt.datetime(2024, 1, day, 1))["rows"])
        merged.append(run_silver_master_incremental(spark, cfg, dt.datetime(2024, 1, day, 2)))
    assert [m["version"] for m in merged] == [0, 1, 2]
    # Each merge reads the new extraction plus the previous one (>= high water,
    # idempotent), never the older bronze days.
    assert merged[2]["rows_merged"] == extracted[1] + extracted[2] < sum(extracted)
    full = LakeConfig(root=f"{lake}/full", db="full_lake")
    run_extract(spark, src, full, dt.datetime(2024, 1, 3, 1))
    run_silver_master(spark, full, dt.datetime(2024, 1, 3, 2))
    # Same loans and versions; only the ingestion stamps differ (three runs vs one).
    a = current_silver_master(spark, cfg).drop("_silver_ts", "_ingestion_ts")
    b = spark.read.parquet(full.silver_master).select(*a.columns)
    assert a.count() == b.count()
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_run_metrics_come_from_the_write_itself(spark, lake):
    from ledgerlake.operators.metrics import with_run_metrics

    df, obs = with_run_metrics(spark.range(123), "rows_written")
    overwrite_table(df, f"{lake}/m")
    assert obs.get["rows"] == 123


def test_scale_conf_sizes_partitions_from_input():
    from ledgerlake.session import scale_conf

    conf = scale_conf(100 * (1 << 40))
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert scale_conf(1 << 20)["spark.sql.shuffle.partitions"] == "8"


def test_events_pipeline_runs_before_any_master(spark, lake):
    cfg = LakeConfig(root=lake, db="events_first")
    append_bronze(X.bronze_loan_events(spark, SF), cfg.bronze_events, "2024-01-01 05:00:00", with_hour=True, fmt="json")
    out = run_events_pipeline(spark, cfg, run_ts=dt.datetime(2024, 1, 2))
    assert out["gold"]["fact_loan_event_activity"] == out["silver"]["rows_out"]
    act = spark.read.parquet(cfg.gold_table("fact_loan_event_activity"))
    assert act.filter("loan_type is not null").count() == 0
