from __future__ import annotations

import json
import os

from ledgerlake import fixtures as X
from ledgerlake.plans.config import LakeConfig
from ledgerlake.plans.layers import silver_loan_events
from ledgerlake.sinks.files import append_bronze
from ledgerlake.sources.bronze import read_bronze_events
from ledgerlake.streaming.dedup import dedup_stream
from ledgerlake.streaming.ingest import decode_events, file_event_stream, start_bronze_stream
from ledgerlake.streaming.refresh import current_silver_events, refresh_gold_events, refresh_silver_events
from ledgerlake.operators.normalize import normalize_loan_events

SF = "/root/testdata/sf0.001"


def _write_messages(path: str, name: str, messages: list[tuple[dict | str, int, int]]) -> None:
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for payload, part, off in messages:
            value = payload if isinstance(payload, str) else json.dumps(payload)
            f.write(json.dumps({"value": value, "partition": part, "offset": off}) + "\n")


def _event(i: int, loan: str = "L0000001") -> dict:
    return {
        "loan_id": loan, "customer_id": "C00001", "event_type": "PAYMENT", "amount": 10.0 + i, "currency": "USD",
        "loan_type": "AUTO", "status": "CURRENT", "account_number": "AC1",
        "event_ts": f"2024-01-01T00:00:{i:02d}+00:00", "_ingestion_ts": f"2024-01-01T00:00:{i:02d}+00:00",
        "_source_topic": "loan-events-raw", "_producer_version": "1.0.0",
    }


def test_topic_to_bronze_exactly_once_and_corrupt_kept(spark, lake):
    src, out, ckpt = f"{lake}/topic", f"{lake}/bronze", f"{lake}/ckpt"
    _write_messages(src, "a.json", [(_event(i), i % 3, i) for i in range(10)] + [('{"loan_id":', 0, 99)])
    q = start_bronze_stream(decode_events(file_event_stream(spark, src)), out, ckpt, trigger={"availableNow": True})
    q.awaitTermination()
    rows = read_bronze_events(spark, out).collect()
    assert len(rows) == 11
    assert [r._corrupt_value for r in rows if r._corrupt_value is not None] == ['{"loan_id":']
    assert silver_loan_events(read_bronze_events(spark, out)).count() == 10
    assert [r._partition for r in rows if r._offset == 7] == [1]
    # Restart from the checkpoint: nothing new, nothing duplicated.
    q = start_bronze_stream(decode_events(file_event_stream(spark, src)), out, ckpt, trigger={"availableNow": True})
    q.awaitTermination()
    assert read_bronze_events(spark, out).count() == 11
    # New messages arrive: only they are appended.
    _write_messages(src, "b.json", [(_event(i, "L0000002"), 0, 100 + i) for i in range(4)])
    q = start_bronze_stream(decode_events(file_event_stream(spark, src)), out, ckpt, trigger={"availableNow": True})
    q.awaitTermination()
    assert read_bronze_events(spark, out).count() == 15
    assert os.path.isdir(out) and any(p.startswith("year=") for p in os.listdir(out))


def test_dedup_stream_drops_redeliveries(spark, lake):
    src = f"{lake}/topic"
    msgs = [(_event(i), 0, i) for i in range(6)] + [(_event(i), 0, 100 + i) for i in range(6)]
    _write_messages(src, "a.json", msgs)
    stream = dedup_stream(normalize_loan_events(decode_events(file_event_stream(spark, src))))
    q = stream.writeStream.format("memory").queryName("dedup_out").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("dedup_out").count() == 6


def _files(path: str) -> dict[str, float]:
    out = {}
    for d, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                out[os.path.join(d, n)] = os.path.getmtime(os.path.join(d, n))
    return out


def test_incremental_silver_refresh_equals_batch(spark, lake):
    cfg = LakeConfig(root=lake, db="stream_lake", checkpoints=f"{lake}/ckpts")
    bronze = X.bronze_loan_events(spark, SF)
    first, second = bronze.filter("event_ts < '2024-01-15'"), bronze.filter("event_ts >= '2024-01-15'")
    append_bronze(first, cfg.bronze_events, "2024-01-01 01:00:00", with_hour=True, fmt="json")
    refresh_silver_events(spark, cfg, "2024-01-02 00:00:00").awaitTermination()
    before = _files(cfg.silver_events_incremental)
    append_bronze(second, cfg.bronze_events, "2024-01-01 02:00:00", with_hour=True, fmt="json")
    refresh_silver_events(spark, cfg, "2024-01-02 00:00:00").awaitTermination()
    after = _files(cfg.silver_events_incremental)
    # Date partitions the second batch does not touch keep their files.
    touched = {str(r.d) for r in second.selectExpr("to_date(to_timestamp(event_ts)) as d").distinct().collect()}
    untouched = {f: t for f, t in before.items() if not any(f"event_date={d}" in f for d in touched)}
    assert untouched and all(after.get(f) == t for f, t in untouched.items())
    # Replay of already-landed input (a re-sent file) must not change the result.
    append_bronze(first.limit(100), cfg.bronze_events, "2024-01-01 03:00:00", with_hour=True, fmt="json")
    # A backlog processed as several bounded micro-batches gives the same table.
    refresh_silver_events(spark, cfg, "2024-01-02 00:00:00", max_files_per_trigger=1).awaitTermination()
    got = current_silver_events(spark, cfg)
    want = silver_loan_events(bronze, "2024-01-02 00:00:00")
    cols = [c for c in want.columns]
    got, want = got.select(*cols), want.select(*cols)
    assert got.count() == want.count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_refresh_gold_events_from_incremental_silver(spark, lake):
    from ledgerlake.plans.pipelines import run_batch_pipeline

    cfg = LakeConfig(root=lake, db="stream_gold", checkpoints=f"{lake}/ckpts")
    run_batch_pipeline(spark, X.bronze_loan_master(spark, SF).drop("_ingestion_ts"), cfg, as_of=X.AS_OF)
    append_bronze(X.bronze_loan_events(spark, SF), cfg.bronze_events, "2024-01-01 01:00:00", with_hour=True, fmt="json")
    out = refresh_gold_events(spark, cfg)
    assert out["fact_loan_event_activity"] == silver_loan_events(X.bronze_loan_events(spark, SF)).count()
    total = spark.read.parquet(cfg.gold_table("fact_event_summary")).agg({"event_count": "sum"}).first()[0]
    assert total == out["fact_loan_event_activity"]


def test_incremental_gold_refresh_recomputes_only_stale_dates_and_equals_full_rebuild(spark, lake):
    import datetime as dt

    from pyspark.sql import functions as F

    from ledgerlake.operators.facts import fact_loan_event_activity
    from ledgerlake.operators.summary import event_summary
    from ledgerlake.plans.pipelines import (
        GOLD_ACTIVITY_BY_DATE, GOLD_SUMMARY_BY_MONTH, current_silver_master, run_batch_pipeline,
    )
    from ledgerlake.sources.dims import dim_loan_type, dim_status

    cfg = LakeConfig(root=lake, db="stream_inc", checkpoints=f"{lake}/ckpts")
    src = X.bronze_loan_master(spark, SF).drop("_ingestion_ts")
    run_batch_pipeline(spark, src, cfg, as_of=X.AS_OF, run_ts=dt.datetime(2024, 2, 1), incremental_silver=True)
    bronze = X.bronze_loan_events(spark, SF)
    early, late = bronze.filter("event_ts < '2024-01-15'"), bronze.filter("event_ts >= '2024-01-20'")

    def refresh(hour):
        return refresh_gold_events(spark, cfg, dt.datetime(2024, 2, 1, hour), incremental=True)

    append_bronze(early, cfg.bronze_events, "2024-01-01 01:00:00", with_hour=True, fmt="json")
    first = refresh(1)
    assert first["stale_dates"] == 14
    activity_path = cfg.gold_table(GOLD_ACTIVITY_BY_DATE)
    before = _files(activity_path)

    append_bronze(late, cfg.bronze_events, "2024-01-01 02:00:00", with_hour=True, fmt="json")
    second = refresh(2)
    late_dates = {str(r.d) for r in late.selectExpr("to_date(to_timestamp(event_ts)) as d").distinct().collect()}
    assert second["stale_dates"] == len(late_dates)
    after = _files(activity_path)
    assert before and all(after.get(f) == t for f, t in before.items())  # early dates untouched

    # New master versions of a few loans with events: only their event dates go stale.
    events_now = current_silver_events(spark, cfg)
    loans = [r.loan_id for r in events_now.join(current_silver_master(spark, cfg), "loan_id", "left_semi")
             .select("loan_id").distinct().orderBy("loan_id").limit(3).collect()]
    changed = src.filter(F.col("loan_id").isin(loans)).dropDuplicates(["loan_id"]) \
        .withColumn("status", F.lit("CHARGED_OFF")).withColumn("MODIFIED_TS", F.lit("2002-01-01 00:00:00"))
    run_batch_pipeline(spark, changed, cfg, as_of=X.AS_OF, run_ts=dt.datetime(2024, 2, 1, 3), incremental_silver=True)
    third = refresh(4)
    want_dates = events_now.filter(F.col("loan_id").isin(loans)).select("event_date").distinct().count()
    assert third["stale_dates"] == want_dates
    assert refresh(5)["stale_dates"] == 0  # nothing changed since

    drop = ["_gold_ts", "_gold_job"]
    master = current_silver_master(spark, cfg)
    full = fact_loan_event_activity(events_now.drop("event_date"), master, dim_loan_type(spark), dim_status(spark))
    got = spark.read.parquet(activity_path)
    cols = [c for c in full.columns if c not in drop]
    assert got.count() == full.count() == events_now.count()
    assert got.select(*cols).exceptAll(full.select(*cols)).isEmpty()
    assert full.select(*cols).exceptAll(got.select(*cols)).isEmpty()
    summary_full = event_summary(full)
    summary_got = spark.read.parquet(cfg.gold_table(GOLD_SUMMARY_BY_MONTH))
    scols = [c for c in summary_full.columns if c not in drop]
    assert summary_got.select(*scols).exceptAll(summary_full.select(*scols)).isEmpty()
    assert summary_full.select(*scols).exceptAll(summary_got.select(*scols)).isEmpty()


def test_incremental_gold_without_change_log_uses_silver_stamps(spark, lake):
    import datetime as dt

    from ledgerlake.plans.pipelines import GOLD_ACTIVITY_BY_DATE, run_batch_pipeline, run_events_pipeline
    from ledgerlake.plans.pipelines import run_gold_events_incremental

    cfg = LakeConfig(root=lake, db="stream_stamps", checkpoints=f"{lake}/ckpts")
    run_batch_pipeline(spark, X.bronze_loan_master(spark, SF).drop("_ingestion_ts"), cfg, as_of=X.AS_OF,
                       run_ts=dt.datetime(2024, 2, 1))
    append_bronze(X.bronze_loan_events(spark, SF), cfg.bronze_events, "2024-01-01 01:00:00", with_hour=True, fmt="json")
    run_events_pipeline(spark, cfg, dt.datetime(2024, 2, 1, 1))
    first = run_gold_events_incremental(spark, cfg, dt.datetime(2024, 2, 1, 2))
    assert first["stale_dates"] == 30
    assert run_gold_events_incremental(spark, cfg, dt.datetime(2024, 2, 1, 3))["stale_dates"] == 0
    assert spark.read.parquet(cfg.gold_table(GOLD_ACTIVITY_BY_DATE)).count() == \
        spark.read.parquet(cfg.silver_events).count()
