"""File sinks: bronze appends, full-refresh overwrites, versioned publishes.

No sink ever reads and overwrites the same path in one job: a static
overwrite deletes the target before the job reads it.  Incremental results
go to a new version directory and a pointer is committed after the data
is complete (``publish_version``), so a crash leaves the previous version
current and intact, and of two writers of one version only one succeeds.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import as_timestamp, ingestion_partition_columns
from ledgerlake.functions.instants import from_micros, to_micros
from ledgerlake.sinks.commitlog import CommitConflict, CommitLog


def is_missing(error: AnalysisException) -> bool:
    """Nothing was written there yet; any other error (schema, listing, rights) is not that."""
    return error.getCondition() == "PATH_NOT_FOUND"


def rebalanced(df: DataFrame, partition_by: list[str] | tuple[str, ...]) -> DataFrame:
    """Rows gathered by partition value before a partitioned write, values too large for one task split.

    Without it every task writes a file for every value it meets.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def append_bronze(
    df: DataFrame,
    path: str,
    run_ts: dt.datetime | str | None = None,
    with_hour: bool = False,
    fmt: str = "parquet",
) -> None:
    """Append under zero-padded ``year/month/day[/hour]`` of the ingestion time (session zone, UTC)."""
    ts = F.current_timestamp() if run_ts is None else as_timestamp(run_ts)
    parts = ingestion_partition_columns(ts, with_hour)
    df.withColumns(parts).write.mode("append").partitionBy(*parts).format(fmt).save(path)


def overwrite_table(df: DataFrame, path: str, partition_by: list[str] | tuple[str, ...] = (), fmt: str = "parquet") -> None:
    """Full-refresh overwrite, optionally partitioned (Snappy Parquet by default)."""
    writer = rebalanced(df, partition_by).write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


# -- versioned tables ---------------------------------------------------------


def write_version(df: DataFrame, root: str, version: int, partition_by: list[str] | tuple[str, ...] = ()) -> str:
    """Write ``df`` as an attempt at version ``version`` of the table at ``root``; its path.

    Every attempt has a directory of its own, so two writers of one version never
    meet in the data; the pointer says whose counts.
    """
    path = f"{root.rstrip('/')}/_v{version:010d}-{uuid.uuid4().hex}"
    overwrite_table(df, path, partition_by)
    return path


ANY = object()


def pointer_log(spark: SparkSession, control_path: str) -> CommitLog:
    stored = "table string, version long, path string, publish_id string, published_us long, high_water_us long"
    return CommitLog(spark, control_path, stored, ("table", "version"))


def read_pointers(spark: SparkSession, control_path: str) -> DataFrame:
    """Published versions with the commit that published them (``seq``)."""
    rows = pointer_log(spark, control_path).latest()
    return rows.select(
        "table", "version", "path", F.timestamp_micros("published_us").alias("published_ts"), "publish_id",
        F.timestamp_micros("high_water_us").alias("high_water"), "seq",
    )


def publish_version(
    spark: SparkSession,
    control_path: str,
    table: str,
    version: int | None,
    path: str,
    high_water: dt.datetime | None = None,
    expected: object = ANY,
) -> int:
    """Commit the pointer that makes ``version`` current (after its data is complete) and return the version.

    ``version`` None takes the next one.  ``expected`` is the version that this one
    follows (None: there was none): if another one was published since, nothing
    is written and ``CommitConflict`` is raised.  ``high_water`` records how far the inputs were consumed (e.g. the newest
    bronze ingestion time merged), so the next run reads only newer input.
    """
    row = {
        "table": table, "version": version, "path": path, "publish_id": uuid.uuid4().hex, "published_us": time.time_ns() // 1000,
        "high_water_us": None if high_water is None else to_micros(high_water),
    }

    def make(number: int) -> list[dict]:
        if expected is not ANY or version is None:
            now = (version_info(spark, control_path, table) or {"version": None})["version"]
            if expected is not ANY and now != expected:
                raise CommitConflict(f"{table}: expected version {expected}, found {now}")
            if version is None:
                row["version"] = 0 if now is None else now + 1
        return [row]

    pointer_log(spark, control_path).append(make)
    return row["version"]


def version_info(spark: SparkSession, control_path: str, table: str, before: int | None = None) -> dict | None:
    """The latest published pointer row of ``table`` (optionally only versions < ``before``), times in UTC."""
    ptr = pointer_log(spark, control_path).latest().filter(F.col("table") == table)
    if before is not None:
        ptr = ptr.filter(F.col("version") < before)
    row = ptr.orderBy(F.col("version").desc(), F.col("seq").desc()).select("table", "version", "path", "publish_id", "seq", "high_water_us").first()
    if row is None:
        return None
    info = row.asDict()
    return {**info, "high_water": from_micros(info.pop("high_water_us"))}


def current_version(spark: SparkSession, control_path: str, table: str, before: int | None = None) -> tuple[int, str] | None:
    """The latest published (version, path) of ``table``, optionally only versions < ``before``."""
    info = version_info(spark, control_path, table, before)
    return None if info is None else (info["version"], info["path"])
