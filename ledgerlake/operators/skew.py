"""Hot-key salting for a left join whose streamed side may hold a hot key.

AQE splits a skewed sort-merge join only when both inputs are plain shuffle
stages.  When the right side's partitioning is inherited from an earlier
operator (e.g. silver master deduplicated by ``loan_id`` in the same plan),
no split happens and one task would get every row of a hot key.  Salting
makes the spread explicit and independent of AQE:

* ``hot_key_salts`` estimates per-key row counts from a Bernoulli sample of
  one column (a scan, no shuffle) and gives each key over
  ``max_group_rows`` rows ``ceil(rows / max_group_rows)`` salts;
* ``salted_left_join`` spreads the left rows of a hot key over its salts by
  a deterministic hash of other columns, and copies the right rows of hot
  keys once per salt (at most ``rows / max_group_rows`` copies in total).

NULL keys match nothing, so they are no group: every such row gets a key of its
own kind (``spread_null_key``) and goes wherever its hash says.

The salt table is materialised once and broadcast only after a check of its rows and bytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.session import checkpoint_dir

DEFAULT_MAX_GROUP_ROWS = 1_000_000
# A salt row is a key and an int; 100,000 of them are a few megabytes.
DEFAULT_BROADCAST_MAX_ROWS = 100_000
MAX_KEY_BYTES = 256
SAMPLES_PER_GROUP = 64
SAMPLE_SEED = 11


def hot_key_salts(df: DataFrame, key: str, max_group_rows: int = DEFAULT_MAX_GROUP_ROWS) -> DataFrame:
    """``(key, _salts)`` for keys estimated over ``max_group_rows`` rows (lazy)."""
    fraction = min(1.0, SAMPLES_PER_GROUP / max_group_rows)
    keys = df.select(key).filter(F.col(key).isNotNull())
    sample = keys if fraction >= 1.0 else keys.sample(fraction=fraction, seed=SAMPLE_SEED)
    per_group = max_group_rows * fraction
    return (
        sample.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > F.lit(per_group))
        .select(key, F.ceil(F.col("_n") / F.lit(per_group)).cast("int").alias("_salts"))
    )


class HotKeys:
    """The salt table, materialised once, with its broadcast decision.

    The table holds at most ``sampled rows / per_group`` keys, i.e. about
    ``rows / max_group_rows``.  Up to ``broadcast_max_rows`` of them are
    fetched in one job into a local relation (exact size known to the
    planner, broadcast); a larger table is checkpointed to the cluster's
    checkpoint folder and shuffle-joined instead.
    """

    def __init__(self, salts: DataFrame, broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS):
        spark = salts.sparkSession
        rows = salts.limit(broadcast_max_rows + 1).collect()
        self.empty = not rows
        self.small = len(rows) <= broadcast_max_rows and all(len(str(r[0])) <= MAX_KEY_BYTES for r in rows)
        if self.small:
            self.table = spark.createDataFrame(rows, salts.schema)
        else:
            checkpoint_dir(spark)
            self.table = salts.checkpoint(eager=True)

    def side(self) -> DataFrame:
        return F.broadcast(self.table) if self.small else self.table


def spread_null_key(key: str, spread_by: Sequence[str]) -> Column:
    """The join key, or for a NULL key a text that no key equals, spread by the hash of other columns."""
    return F.coalesce(F.col(key), F.concat(F.lit("\u0000null "), F.xxhash64(*spread_by).cast("string")))


def spread_left_join(left: DataFrame, right: DataFrame, key: str, spread_by: Sequence[str]) -> DataFrame:
    """``left ⟕ right`` on a text ``key``; rows without a key are not sent to one task."""
    lhs = left.withColumn("_on", spread_null_key(key, spread_by))
    return lhs.join(right.withColumnRenamed(key, "_key"), F.col("_on") == F.col("_key"), "left").drop("_on", "_key")


def salted_left_join(
    left: DataFrame, right: DataFrame, key: str, hot: HotKeys, spread_by: Sequence[str]
) -> DataFrame:
    """``left ⟕ right`` on ``key``, hot keys spread over their salts (plain join when none are hot).

    ``spread_by`` are left columns whose hash picks a row's salt
    (deterministic, so a recomputed task gets the same rows).
    """
    if hot.empty:
        return spread_left_join(left, right, key, spread_by)
    salts = hot.side()
    salt = F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*spread_by), F.col("_salts").cast("long")).cast("int")
    )
    lhs = spread_left_join(left, salts, key, spread_by).withColumn("_salt", salt).drop("_salts")
    lhs = lhs.withColumn("_on", spread_null_key(key, spread_by))
    copies = F.when(F.col("_salts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_salts") - 1))
    rhs = right.join(salts, key, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    rhs = rhs.withColumnRenamed(key, "_key").withColumnRenamed("_salt", "_rsalt")
    on = (F.col("_on") == F.col("_key")) & (F.col("_salt") == F.col("_rsalt"))
    return lhs.join(rhs, on, "left").drop("_salt", "_rsalt", "_on", "_key")
