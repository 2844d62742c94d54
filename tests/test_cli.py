from __future__ import annotations

import json
import os

from ledgerlake import cli
from ledgerlake import fixtures as X


def test_cli_batch_events_report_ingest(spark, tmp_path, capsys):
    root = str(tmp_path / "lake")
    src = str(tmp_path / "landing")
    X.bronze_loan_master(spark, "/root/testdata/sf0.001").drop("_ingestion_ts").write.parquet(src)
    topic = tmp_path / "topic"
    topic.mkdir()
    with open(topic / "m.json", "w") as f:
        payload = {"loan_id": "L0000007", "customer_id": "C1", "event_type": "PAYMENT", "amount": 3.0, "currency": "USD",
                   "account_number": "A", "event_ts": "2024-01-01T00:00:00+00:00",
                   "_ingestion_ts": "2024-01-01T00:00:00+00:00"}
        f.write(json.dumps({"value": json.dumps(payload), "partition": 0, "offset": 1}) + "\n")

    assert cli.main(["batch", "--root", root, "--db", "cli_lake", "--source-parquet", src, "--as-of", "2001-12-15"]) == 0
    assert cli.main(["ingest", "--root", root, "--db", "cli_lake", "--source-dir", str(topic), "--available-now"]) == 0
    assert cli.main(["events", "--root", root, "--db", "cli_lake"]) == 0
    assert cli.main(["report", "--root", root, "--db", "cli_lake"]) == 0
    out = capsys.readouterr().out
    assert "occ_classification" in out and "delinquency_rate" in out and "PAYMENT" in out
    assert os.path.isdir(os.path.join(root, "gold", "fact_loan_event_activity", "event_type=PAYMENT"))


def test_cli_refresh_is_incremental_and_registers_tables(spark, tmp_path, capsys):
    from ledgerlake.plans.config import LakeConfig
    from ledgerlake.sinks.files import append_bronze

    root, ckpts = str(tmp_path / "lake"), str(tmp_path / "ckpts")
    src = str(tmp_path / "landing")
    X.bronze_loan_master(spark, "/root/testdata/sf0.001").drop("_ingestion_ts").write.parquet(src)
    args = ["--root", root, "--db", "cli_refresh", "--checkpoints", ckpts]
    assert cli.main(["batch", *args, "--source-parquet", src, "--as-of", "2001-12-15"]) == 0
    events = X.bronze_loan_events(spark, "/root/testdata/sf0.001")
    append_bronze(events, LakeConfig(root=root).bronze_events, "2024-01-01 01:00:00", with_hour=True, fmt="json")
    capsys.readouterr()
    assert cli.main(["refresh", *args]) == 0
    first = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert first["stale_dates"] == 30
    assert cli.main(["refresh", *args]) == 0
    second = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert second["stale_dates"] == 0
    n = spark.sql("select count(*) as n from cli_refresh.fact_loan_event_activity_by_date").first().n
    assert n == first["fact_loan_event_activity"] > 0
