"""Session setup for jobs, tests and the benchmark.

Library transforms never create sessions or set configuration; entry
points call ``build_session`` (new session) or ``prepare_session`` (a
session someone else built).  Cluster settings always win: the checkpoint
directory is only filled in when the cluster did not name one.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the library's semantics depend on.
REQUIRED_CONF = {
    # Calendar parts of event times and ingestion partitions are UTC.
    "spark.sql.session.timeZone": "UTC",
}

# Runtime re-planning: size-checked broadcast of small shuffled sides,
# partition coalescing and skew-join splitting.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20, executors_cores: int | None = None) -> dict[str, str]:
    """Shuffle and scan sizing for a job reading ``input_bytes`` (pass to ``build_session`` or spark-submit).

    Starts AQE with enough shuffle partitions that each holds about
    ``target_partition_bytes`` of the largest shuffle (here the input itself,
    since dedup and joins shuffle whole tables), never fewer than the cores,
    and lets AQE coalesce small ones and split skewed ones at runtime.  At
    100 TB this is ~400k initial partitions, coalesced toward the advisory
    size; scan splits stay at 256 MB so tasks fit in executor memory.
    """
    partitions = max(executors_cores or 0, -(-input_bytes // target_partition_bytes), 8)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for RDD checkpoints: ``spark.checkpoint.dir``, else a folder of the warehouse, on any master.

    Each application gets a folder of its own inside it, so nothing that has to
    outlive the application (streaming progress) may be kept there.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    return sc.getCheckpointDir()


def prepare_session(spark: SparkSession) -> SparkSession:
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    if spark.sparkContext.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            spark.sparkContext.setCheckpointDir(configured)
    return spark


def build_session(master: str = "local[*]", app: str = "ledgerlake", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    settings = {**DEFAULT_CONF, **REQUIRED_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare_session(spark)
