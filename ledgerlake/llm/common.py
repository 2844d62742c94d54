"""Helpers shared by the operators of this subpackage.

Intermediate results that several steps read are written as Parquet under the
cluster's ``spark.checkpoint.dir`` (``scratch_table``): lineage ends there, a
lost executor loses nothing, and the data is read column by column.
"""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def columns_of(df: DataFrame) -> list:
    """All columns, whatever their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    ``spark.checkpoint.dir`` where the cluster names one (or the folder set on
    the context); where neither is set, as in tests, a folder in the warehouse,
    which is shared by definition.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (root or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch").rstrip("/")


def scratch_table(df: DataFrame, name: str, **options) -> tuple[DataFrame, str]:
    """Write ``df`` under the shared folder and return it as read back, with its path; ``options`` are the writer's."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}.parquet"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete intermediate tables that no later step reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps now; else they stay until the driver collects garbage.

    References from Python go first, and the cleaner works in the background, hence two passes with a pause.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mark_copies(ids: DataFrame) -> DataFrame:
    """``ids`` (a written table with key, tag, tag2) with is_copy: whether a smaller key has the same text.

    Texts that occur under several keys are reduced to their smallest key (map-side
    first) and written; the join back then meets two plain tables, so Spark
    broadcasts the few classes or splits a hot one.
    """
    classes = ids.groupBy("tag", "tag2").agg(F.min("key").alias("first"), F.max("key").alias("last")).filter("first <> last")
    classes, _ = scratch_table(classes.select("tag", "tag2", "first"), "copy-classes")
    is_copy = F.coalesce(F.col("key") != F.col("first"), F.lit(False))
    return ids.join(classes, ["tag", "tag2"], "left").withColumn("is_copy", is_copy).drop("first")


def connected_components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst: long); component = smallest node reachable.

    Random-order contraction: each round every node joins the neighbour that
    comes first in a hash order drawn anew for the round, and the links are
    rewritten to the survivors.  A constant share of the nodes goes in each
    round whatever the shape (chains included).  Hubs only ever meet a
    map-side-combined ``min`` and joins that the optimizer can split.
    """
    spark = edges.sparkSession
    current, path = scratch_table(edges.filter("src <> dst").select("src", "dst").distinct(), "cc-edges")
    if current.isEmpty():
        return edges.sparkSession.createDataFrame([], "node long, component long")
    labels = current.select(F.explode(F.array("src", "dst")).alias("node")).distinct().withColumn("at", F.col("node"))
    old: list[str] = []
    for k in range(max_rounds):
        order = lambda c: F.struct(F.xxhash64(c, F.lit(k)).alias("h"), c.alias("v"))  # noqa: B023, E731
        both = current.select(F.explode(F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))).alias("e"))
        both = both.select("e.src", "e.dst")
        first = both.groupBy("src").agg(F.min(order(F.col("dst"))).alias("m"))
        hop, hop_path = scratch_table(first.select(F.col("src").alias("v"), F.least("m", order(F.col("src")))["v"].alias("to")), "cc-hop")
        a, b = hop.toDF("src", "s"), hop.toDF("dst", "d")
        moved = current.join(a, "src").join(b, "dst").filter("s <> d")
        moved = moved.select(F.least("s", "d").alias("src"), F.greatest("s", "d").alias("dst")).distinct()
        labels, label_path = scratch_table(
            labels.join(hop.toDF("at", "to"), "at", "left").select("node", F.coalesce("to", "at").alias("at")), "cc-label"
        )
        current, edge_path = scratch_table(moved, "cc-edges")
        drop_scratch(spark, path, hop_path, *old)
        path, old = edge_path, [label_path]
        if current.isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    least = labels.groupBy("at").agg(F.min("node").alias("component"))
    return labels.join(least, "at").select("node", "component")
