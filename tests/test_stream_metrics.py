from __future__ import annotations

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.normalize import normalize_loan_events
from ledgerlake.plans.config import LakeConfig
from ledgerlake.plans.layers import silver_loan_events
from ledgerlake.sources.bronze import BRONZE_LOAN_EVENTS_READ
from ledgerlake.streaming import refresh as R
from ledgerlake.streaming.dedup import latest_stream
from ledgerlake.streaming.ingest import decode_events, file_event_stream, start_bronze_stream
from ledgerlake.streaming.metrics import observed, start_recording, stream_metrics


def event(loan, day, amount, ingested, offset, kind="PAYMENT"):
    return {
        "loan_id": loan, "customer_id": "C1", "event_type": kind, "amount": amount, "currency": "USD", "event_ts": None if day is None else f"2001-07-{day:02d}T00:00:00+00:00",
        "_ingestion_ts": f"2001-08-01T00:00:{ingested:02d}+00:00", "_partition": 0, "_offset": offset,
    }


def land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        f.write("".join(r if isinstance(r, str) else json.dumps(r) + "\n" for r in rows))


def test_refresh_batches_have_a_row_each_also_after_a_restart(spark, lake):
    cfg = LakeConfig(root=lake, db="metrics")
    folder = f"{cfg.bronze_events}/year=2001/month=08/day=01/hour=00"
    land(folder, "a", [event("L1", 1, 1.0, 1, 1), event("L1", 1, 2.0, 2, 2), event("L2", 1, 1.0, 1, 3), '{"loan_id":\n'])
    R.refresh_silver_events(spark, cfg).awaitTermination()
    land(folder, "b", [event("L1", 1, 3.0, 3, 4), event("L3", 2, 1.0, 1, 5)])
    R.refresh_silver_events(spark, cfg).awaitTermination()
    land(folder, "c", ["not json\n", "nor this\n"])
    R.refresh_silver_events(spark, cfg).awaitTermination()
    rows = stream_metrics(spark, cfg).orderBy("batch_id").collect()
    assert [(r.query, r.batch_id, r.rows_in, r.rows_corrupt, r.rows_duplicate, r.rows_out) for r in rows] == [
        (R.REFRESH_QUERY, 0, 4, 1, 1, 2), (R.REFRESH_QUERY, 1, 2, 0, 1, 1), (R.REFRESH_QUERY, 2, 2, 2, 0, 0),
    ]
    assert {(r.loan_id, float(r.amount)) for r in R.current_silver_events(spark, cfg).collect()} == {("L1", 3.0), ("L2", 1.0), ("L3", 1.0)}


def test_a_listener_records_the_bronze_stream(spark, lake):
    cfg = LakeConfig(root=lake, db="listened")
    recorder = start_recording(spark, cfg)
    try:
        for k, values in enumerate([[event("L1", 1, 1.0, 1, 1), event("L2", 1, 1.0, 1, 2)], [event("L3", 1, 1.0, 1, 3)]]):
            lines = [{"value": json.dumps(v), "partition": 0, "offset": i} for i, v in enumerate(values)]
            land(f"{lake}/in", f"f{k}", [*lines, {"value": "broken {", "partition": 0, "offset": 9}])
            stream = observed(decode_events(file_event_stream(spark, f"{lake}/in")))
            start_bronze_stream(stream, cfg.bronze_events, f"{lake}/ck", trigger={"availableNow": True}, query_name="bronze_events").awaitTermination()
        for _ in range(60):  # progress arrives a moment after the batch
            rows = stream_metrics(spark, cfg).orderBy("batch_id").collect()
            if len(rows) == 2:
                break
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(recorder)
    assert [(r.query, r.rows_in, r.rows_corrupt, r.rows_duplicate, r.rows_out) for r in rows] == [("bronze_events", 3, 1, None, 3), ("bronze_events", 2, 1, None, 2)]
    assert rows[0].batch_id < rows[1].batch_id


def test_latest_stream_replaces_within_the_delay_and_forgets(spark, lake):
    folder, out = f"{lake}/ev", f"{lake}/out"
    batches = [
        [event("L1", 1, 1.0, 1, 1), event("L2", 1, 5.0, 1, 2), event(None, 1, 7.0, 1, 3), event("L9", None, 1.0, 1, 4)],
        [event("L1", 1, 2.0, 9, 5), event("L2", 1, 6.0, 0, 6)],  # the first is newer, the second older than what is held
        [event("L3", 20, 1.0, 1, 7)],  # the watermark passes the first day
        [event("L1", 1, 3.0, 50, 8), event("L4", 28, 1.0, 1, 9)],  # too late
        [event("L5", 31, 1.0, 1, 10)],
    ]
    states = []
    for k, rows in enumerate(batches):
        land(folder, f"b{k}", rows)
        stream = normalize_loan_events(spark.readStream.schema(BRONZE_LOAN_EVENTS_READ).json(folder))
        query = latest_stream(stream, delay="1 day").writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{lake}/ck")
        query = query.trigger(availableNow=True).outputMode("append").start()
        query.awaitTermination()
        states.append(max(o.numRowsTotal for p in query.recentProgress for o in p.stateOperators))
    got = {(r.loan_id, r.event_ts.day, float(r.amount)) for r in spark.read.parquet(out).collect()}
    held = [b for rows in batches[:3] for b in rows] + [batches[3][1]]
    want = silver_loan_events(spark.createDataFrame([(json.dumps(r),) for r in held], "v string").select(F.from_json("v", BRONZE_LOAN_EVENTS_READ).alias("r")).select("r.*"))
    want = {(r.loan_id, r.event_ts.day, float(r.amount)) for r in want.filter("event_ts < '2001-07-29'").collect()}
    assert got == want == {("L1", 1, 2.0), ("L2", 1, 5.0), (None, 1, 7.0), ("L3", 20, 1.0), ("L4", 28, 1.0)}
    assert states[1] == 3 and states[-1] <= 2
    with pytest.raises(ValueError, match="must contain"):
        latest_stream(stream, keys=["loan_id"])
