"""Latest-row-per-key deduplication and keyed merges.

``latest_per_key`` is ``row_number() = 1`` over a key window.  Catalyst
rewrites that filter into a *partial* WindowGroupLimit before the shuffle
and a final one after it, so each map task ships at most one row per key:
a key holding a third of all rows still reaches its reducer as one row per
map task, never as an unbounded group.

Order columns are always a total order (explicit tie-breakers, NULLs last),
so the winner does not depend on input order or partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Loan master: newest version, then newest ingestion of that version.
MASTER_KEYS = ("loan_id",)
MASTER_RANK = ("MODIFIED_TS", "_ingestion_ts")


def newest_first(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def master_order() -> list[Column]:
    return newest_first(MASTER_RANK)


# Loan events: event identity; latest ingestion, then the latest topic position
# (a redelivery carries the same producer timestamp, so ingestion alone ties).
EVENT_KEYS = ("loan_id", "event_ts", "event_type")


EVENT_RANK = ("_ingestion_ts", "_partition", "_offset")


def event_order() -> list[Column]:
    return newest_first(EVENT_RANK)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[Column]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order_cols``; drop the rest."""
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn("_row_num", F.row_number().over(w)).filter(F.col("_row_num") == 1).drop("_row_num")


def merge_latest(current: DataFrame, increment: DataFrame, keys: Sequence[str], rank: Sequence[str]) -> DataFrame:
    """Upsert ``increment`` into ``current`` (one row per key; newest by ``rank`` wins), equal to a full recompute.

    The increment is reduced to one row per key first.  ``current`` is read
    once for its rows, in a left join to that reduced increment that keeps the
    newer of the two; keys that are new come from an anti join against
    ``current``'s key columns alone.  AQE broadcasts a small increment, so the
    large side is then not shuffled at all.  A tie keeps the current row.
    Write the result to a new location, never over ``current``'s own files.
    """
    names = current.columns
    latest = latest_per_key(increment.select(*names), keys, newest_first(rank))
    new = latest.select(F.struct(*names).alias("_new"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, [current[k].eqNullSafe(new[f"_k{i}"]) for i, k in enumerate(keys)])
    # In a struct comparison NULL is the smallest value, which is "nulls last" for newest first.
    newer = F.struct(*[F.col(f"_new.{c}") for c in rank]) > F.struct(*[F.col(c) for c in rank])
    both = current.join(new, same, "left").withColumn("_take", F.col("_new").isNotNull() & newer)
    kept = both.select(*[F.when(F.col("_take"), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in names])
    known = current.select(*[F.col(k).alias(f"_c{i}") for i, k in enumerate(keys)])
    unseen = reduce(lambda a, b: a & b, [latest[k].eqNullSafe(known[f"_c{i}"]) for i, k in enumerate(keys)])
    return kept.unionByName(latest.join(known, unseen, "left_anti"))
