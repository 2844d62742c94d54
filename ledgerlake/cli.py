"""Job entry point for ``spark-submit`` (one subcommand per scheduled job).

    spark-submit -m ledgerlake.cli batch  --root s3a://lake --source-parquet s3a://landing/loan_master
    spark-submit -m ledgerlake.cli batch  --root s3a://lake --jdbc-url jdbc:... --jdbc-table loan_master
    spark-submit -m ledgerlake.cli events --root s3a://lake
    spark-submit -m ledgerlake.cli ingest --root s3a://lake --kafka-bootstrap broker:9092
    spark-submit -m ledgerlake.cli refresh --root s3a://lake
    spark-submit -m ledgerlake.cli report --root s3a://lake
    spark-submit -m ledgerlake.cli sweep --root s3a://lake --keep-days 7

Cluster settings (master, executors, ``spark.checkpoint.dir``) come from the
submit command; nothing here is hard-coded.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
from dataclasses import replace

from pyspark.sql import SparkSession

from ledgerlake import constants as K
from ledgerlake.plans import analytics as A
from ledgerlake.plans.config import LakeConfig
from ledgerlake.plans.history import run_history_incremental
from ledgerlake.plans.pipelines import gold_event_totals, register_all, run_batch_pipeline, run_events_pipeline
from ledgerlake.session import prepare_session
from ledgerlake.sinks.retention import KEEP, sweep
from ledgerlake.sources.incremental import jdbc_source
from ledgerlake.sources.watermark import get_watermark
from ledgerlake.streaming.compact import refresh_gold_from_compacted
from ledgerlake.streaming.ingest import decode_events, file_event_stream, kafka_event_stream, start_bronze_stream
from ledgerlake.streaming.metrics import observed, start_recording
from ledgerlake.streaming.refresh import refresh_gold_events


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerlake")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("batch", "events", "ingest", "refresh", "report", "sweep"):
        s = sub.add_parser(name)
        s.add_argument("--root", required=True, help="lake root (shared storage)")
        s.add_argument("--db", default="loan_lake")
        s.add_argument("--checkpoints", default=None, help="streaming progress (default: <root>/_checkpoints)")
    b = sub.choices["batch"]
    b.add_argument("--source-parquet")
    b.add_argument("--jdbc-url")
    b.add_argument("--jdbc-table", default="loan_master")
    b.add_argument("--jdbc-partition-column", help="numeric column: the table is read by ranges of it, in parallel")
    b.add_argument("--jdbc-lower", type=int)
    b.add_argument("--jdbc-upper", type=int)
    b.add_argument("--jdbc-partitions", type=int, default=16)
    b.add_argument("--lookback-seconds", type=int, default=0, help="margin behind the watermark that is read again")
    b.add_argument("--first-watermark", default=K.DEFAULT_WATERMARK, help="where the first extraction starts (UTC)")
    b.add_argument("--incremental-silver", action="store_true", help="merge new bronze rows instead of rebuilding silver")
    b.add_argument("--history", action="store_true", help="merge new bronze rows into the loan history")
    b.add_argument("--as-of", default=None)
    b.add_argument("--jdbc-text-time", action="store_true", help="MODIFIED_TS is text: rows certainly before the watermark stay in the database")
    sub.choices["sweep"].add_argument("--keep-days", type=float, default=KEEP.days, help="how long unreachable data stays readable")
    sub.choices["refresh"].add_argument("--compacted", action="store_true", help="gather the small JSON files into columnar ones and read those")
    i = sub.choices["ingest"]
    i.add_argument("--kafka-bootstrap")
    i.add_argument("--source-dir", help="Kafka-shaped JSON-lines files instead of a topic")
    i.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    i.add_argument("--worker", default="spark")
    i.add_argument("--min-partitions", type=int, help="split large topic partitions over so many tasks")
    i.add_argument("--max-offsets-per-trigger", type=int, default=50_000_000, help="most messages of a micro-batch, the first one too")
    i.add_argument("--max-files-per-trigger", type=int, help="the same for --source-dir")
    return p


def text_time_bound(spark: SparkSession, cfg: LakeConfig) -> dict:
    """The source-side bound of the next extraction, for ``jdbc_source``."""
    wm = get_watermark(spark, cfg.watermarks, cfg.source_table, cfg.first_watermark)
    return {"text_time": "MODIFIED_TS", "watermark": wm - (cfg.lookback or dt.timedelta())}


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = prepare_session(SparkSession.builder.appName(f"ledgerlake-{args.cmd}").getOrCreate())
    cfg = LakeConfig(root=args.root, db=args.db, checkpoints=args.checkpoints)
    if args.cmd == "batch":
        back = dt.timedelta(seconds=args.lookback_seconds) if args.lookback_seconds else None
        cfg = replace(cfg, lookback=back, first_watermark=args.first_watermark)
    if args.cmd == "batch":
        if args.jdbc_url:
            if args.jdbc_partition_column and (args.jdbc_lower is None or args.jdbc_upper is None):
                raise SystemExit("--jdbc-partition-column needs --jdbc-lower and --jdbc-upper")
            source = jdbc_source(
                spark, args.jdbc_url, args.jdbc_table, partition_column=args.jdbc_partition_column,
                lower_bound=args.jdbc_lower, upper_bound=args.jdbc_upper, num_partitions=args.jdbc_partitions,
                **(text_time_bound(spark, cfg) if args.jdbc_text_time else {}),
            )
        elif args.source_parquet:
            source = spark.read.parquet(args.source_parquet)
        else:
            raise SystemExit("batch needs --source-parquet or --jdbc-url")
        print(json.dumps(run_batch_pipeline(spark, source, cfg, as_of=args.as_of, incremental_silver=args.incremental_silver), default=str))
        if args.history:
            print(json.dumps(run_history_incremental(spark, cfg), default=str))
    elif args.cmd == "events":
        print(json.dumps(run_events_pipeline(spark, cfg), default=str))
        gold_event_totals(spark, cfg).show(truncate=False)
    elif args.cmd == "ingest":
        raw = (
            kafka_event_stream(
                spark, args.kafka_bootstrap, min_partitions=args.min_partitions, max_offsets_per_trigger=args.max_offsets_per_trigger
            )
            if args.kafka_bootstrap
            else file_event_stream(spark, args.source_dir, args.max_files_per_trigger)
        )
        ckpt = cfg.checkpoint("bronze_events")
        trigger = {"availableNow": True} if args.available_now else None
        start_recording(spark, cfg)
        events = observed(decode_events(raw, args.worker))
        start_bronze_stream(events, cfg.bronze_events, ckpt, trigger=trigger, query_name="bronze_events").awaitTermination()
    elif args.cmd == "refresh":
        out = refresh_gold_from_compacted(spark, cfg) if args.compacted else refresh_gold_events(spark, cfg, incremental=True)
        print(json.dumps(out, default=str))
        register_all(spark, cfg)
    elif args.cmd == "sweep":
        print(json.dumps(sweep(spark, cfg, dt.timedelta(days=args.keep_days))))
    elif args.cmd == "report":
        for fn in (A.risk_by_occ, A.volume_by_event_type, A.delinquency_by_type):
            fn(spark, cfg.db).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
