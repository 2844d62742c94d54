"""Run metrics without extra passes.

``with_run_metrics`` attaches an ``Observation`` to a DataFrame: the counts
are computed by the same job that writes the data, instead of a separate
``count()`` that would re-run the whole lineage.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def with_run_metrics(df: DataFrame, name: str, **aggs: Column) -> tuple[DataFrame, Observation]:
    """Return ``df`` instrumented with a row counter (and ``aggs``); read ``obs.get`` after the action."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in aggs.items()]), obs


def dedup_metrics(datasets: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Rows in, rows out and duplicates removed per dataset, from one scan of each.

    ``datasets`` maps a name to its rows (before the dedup) and the key columns.
    Rows are counted by key with map-side combine; the rows out are the keys.
    """
    parts = []
    for name, (rows, keys) in datasets.items():
        by_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        totals = by_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"), F.count(F.lit(1)).alias("rows_out"))
        parts.append(totals.select(F.lit(name).alias("dataset"), "rows_in", "rows_out"))
    return reduce(DataFrame.unionByName, parts).withColumn("duplicates_removed", F.col("rows_in") - F.col("rows_out"))
