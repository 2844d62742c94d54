from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ledgerlake import fixtures as X
from ledgerlake.plans.config import LakeConfig
from ledgerlake.plans.layers import silver_loan_events
from ledgerlake.sinks.files import append_bronze
from ledgerlake.sinks.retention import sweep
from ledgerlake.streaming import compact as C
from ledgerlake.streaming import refresh as R
from ledgerlake.streaming.metrics import stream_metrics

SF = "/root/testdata/sf0.001"


def _land(spark, cfg, hour, rows, files=6):
    append_bronze(rows.repartition(files), cfg.bronze_events, f"2024-01-01 {hour:02d}:00:00", with_hour=True, fmt="json")


def test_compacted_files_are_read_once_whatever_crashes(spark, lake, monkeypatch):
    cfg = LakeConfig(root=lake, db="compact")
    bronze = X.bronze_loan_events(spark, SF)
    part = F.col("_offset") % 3
    _land(spark, cfg, 1, bronze.filter(part == 0))
    with open(f"{cfg.bronze_events}/year=2024/month=01/day=01/hour=01/bad.json", "w") as f:
        f.write("not json\n")
    C.compact_bronze_events(spark, cfg).awaitTermination()
    assert C.refresh_from_compacted(spark, cfg, X.RUN_TS) == 1 and C.refresh_from_compacted(spark, cfg, X.RUN_TS) == 0
    # a crash before the compaction's commit: the batch is written again, its first directory counts for nothing
    _land(spark, cfg, 2, bronze.filter(part == 1))
    real = C.CommitLog.append
    monkeypatch.setattr(C.CommitLog, "append", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost the driver")))
    with pytest.raises(Exception, match="lost the driver"):
        C.compact_bronze_events(spark, cfg).awaitTermination()
    monkeypatch.setattr(C.CommitLog, "append", real)
    C.compact_bronze_events(spark, cfg).awaitTermination()
    # a replay of a committed batch is skipped
    C.compact_batch(spark, cfg, bronze.limit(0), 1)
    # a crash before the refresh's commit leaves dates and progress as they were
    monkeypatch.setattr(R, "commit_dates", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost the driver")))
    with pytest.raises(RuntimeError):
        C.refresh_from_compacted(spark, cfg, X.RUN_TS)
    monkeypatch.undo()
    assert R.compacted_upto(spark, cfg) == 0
    _land(spark, cfg, 3, bronze.filter(part == 2))
    C.compact_bronze_events(spark, cfg, max_files_per_trigger=3).awaitTermination()
    C.refresh_from_compacted(spark, cfg, X.RUN_TS)
    lines = sum(r.rows_in for r in stream_metrics(spark, cfg).filter(F.col("query") == C.COMPACT_REFRESH).collect())
    assert lines == bronze.count() + 1  # every line was handed over once, the broken one too
    want = silver_loan_events(bronze, X.RUN_TS)
    got = R.current_silver_events(spark, cfg).select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    directories = [r.directory for r in C.compaction_log(spark, cfg).latest().collect()]
    assert len(directories) == len(set(directories)) < len(os.listdir(cfg.bronze_events_compact))
    _land(spark, cfg, 4, bronze.limit(5))
    out = C.refresh_gold_from_compacted(spark, cfg)
    assert out["compacted_batches"] == 1 and out["fact_loan_event_activity"] == want.count()
    files = [n for n in os.listdir(f"{cfg.bronze_events_compact}/{min(directories)}") if n.endswith(".parquet")]
    assert len(files) == 1  # seven JSON files became one
    sweep(spark, cfg)  # the progress row names no directory


def test_a_second_refresh_at_once_drops_its_work(spark, lake, monkeypatch):
    cfg = LakeConfig(root=lake, db="compact_race")
    bronze = X.bronze_loan_events(spark, SF)
    _land(spark, cfg, 1, bronze)
    C.compact_bronze_events(spark, cfg).awaitTermination()
    real, lost = R.commit_dates, []

    def other_first(*args):
        if not lost:
            lost.append(args[3])
            real(*args)
        return real(*args)

    monkeypatch.setattr(R, "commit_dates", other_first)
    assert C.refresh_from_compacted(spark, cfg, X.RUN_TS) == 0 and lost
    assert R.compacted_upto(spark, cfg) == 0
    want = silver_loan_events(bronze, X.RUN_TS)
    got = R.current_silver_events(spark, cfg).select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
