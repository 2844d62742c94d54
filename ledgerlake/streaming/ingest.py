"""Event topic -> bronze, as a Structured Streaming query.

Offsets live in the query checkpoint and the file sink commits each
micro-batch exactly once, so a restart neither loses nor duplicates files,
and there are no object-key collisions (file names are unique per task and
batch).  Undecodable messages are kept with their raw text in
``_corrupt_record`` instead of stopping the stream.

``raw`` streams have the Kafka source shape ``(value string, partition
int, offset long)``.  ``kafka_event_stream`` builds one from a topic (needs
the spark-sql-kafka package on the classpath); ``file_event_stream`` reads
the same shape from JSON-lines files, which tests use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlake import constants as K
from ledgerlake.functions import ingestion_partition_columns
from ledgerlake.schemas import EVENT_PAYLOAD
from ledgerlake.sources.bronze import CORRUPT_VALUE_COLUMN

RAW_SCHEMA = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

_PAYLOAD_WITH_CORRUPT = T.StructType(EVENT_PAYLOAD.fields + [T.StructField(CORRUPT_VALUE_COLUMN, T.StringType())])


def kafka_event_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str = K.EVENT_TOPIC,
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Subscribe to the event topic from the earliest offset (Kafka source).

    ``min_partitions`` splits large topic-partition offset ranges over several
    Spark tasks, so a topic partition holding a third of the traffic is not
    one task; ``max_offsets_per_trigger`` bounds each micro-batch.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load().select(F.col("value").cast("string").alias("value"), "partition", "offset")


def file_event_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The Kafka-shaped stream from JSON-lines files ``{"value": ..., "partition": ..., "offset": ...}``."""
    reader = spark.readStream.schema(RAW_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.json(path)


def decode_events(raw: DataFrame, worker: str = "local") -> DataFrame:
    """Decode message values; add topic position and the ingesting worker's name."""
    parsed = F.from_json(
        F.col("value"),
        _PAYLOAD_WITH_CORRUPT,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_VALUE_COLUMN},
    )
    return raw.select(
        parsed.alias("e"),
        F.col("partition").cast("long").alias("_partition"),
        F.col("offset").cast("long").alias("_offset"),
    ).select(
        *[F.col(f"e.{f.name}").alias(f.name) for f in EVENT_PAYLOAD.fields],
        "_partition",
        "_offset",
        F.lit(worker).alias("_ingest_worker"),
        F.col(f"e.{CORRUPT_VALUE_COLUMN}").alias(CORRUPT_VALUE_COLUMN),
    )


def start_bronze_stream(
    events: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "json",
    trigger: dict[str, object] | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Continuously append decoded events under ``year/month/day/hour`` of ingestion (UTC).

    The ingestion time is the micro-batch's timestamp, which a replayed batch
    reuses, so a retried batch writes the same partition directories.
    """
    parts = ingestion_partition_columns(F.current_timestamp(), with_hour=True)
    writer = (
        events.withColumns(parts)
        .writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*parts)
    )
    if query_name:
        writer = writer.queryName(query_name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
