"""SCD type-2 history of the loan master, skew-safe.

Every distinct (loan, MODIFIED_TS) version becomes a row valid from its
modification time until the next version's (``valid_to`` NULL = current).

The naive plan, ``lead(ts) over (partition by loan_id order by ts)``, sends
all versions of a loan to one task; a loan holding a third of all rows
would then be a third of the job in one task.  ``lead_within_key`` instead:

1. finds the *hot* keys (estimated over ``max_group_rows`` rows) from a
   Bernoulli sample of two columns, about ``SAMPLES_PER_BUCKET`` sampled
   rows per ``max_group_rows`` real ones (no shuffle of the data);
2. builds, per hot key, an adaptive grid over time from the sample: level 1
   cuts the key's sampled range into ``BINS_PER_BUCKET`` equal-width bins
   per bucket's worth of rows; a bin still holding over half a bucket is cut
   again over its *own* sampled range, down to ``LEVELS`` levels, so one far
   outlier or a burst of versions does not put everything in one bin.  Leaf
   bins map to buckets by *cumulative sampled count*, so buckets hold about
   ``max_group_rows`` rows each, balanced by count, not by time.  Every
   lookup is an equi-join on (key, bin path) against a small table, so a row
   costs O(``LEVELS``) hash probes, no search.  The bucket is a monotone
   function of the time, the same on every recomputation; ordinary keys use
   bucket 0;
3. hash-partitions once on (key, bucket) and computes ``lead`` inside each
   bucket: no window group is a whole hot key any more.  ``loan_master_scd2``
   with hot loans first removes exact duplicate versions with a (loan, time)
   shuffle whose partial top-1 limit shrinks a pile of copies before it
   moves; without hot loans no pile can be large either, and one shuffle on
   the loan serves both the version dedup and ``lead``;
4. patches the last row of each hot bucket with the first time of the key's
   next non-empty bucket, from a table of one row per hot bucket that is
   pre-aggregated from a two-column scan of the hot rows before the shuffle
   and broadcast back by AQE (ordinary keys need no patch).

A bucket exceeds ``max_group_rows`` only when more versions than that fall
inside one bin of the deepest level (a burst inside a burst inside a burst);
the window then buffers and spills that group: slower, never wrong.
Whatever the sample misses, results stay exact: any per-key monotone
bucketing gives the same ``lead``.

The grid and bucket tables hold about ``BINS_PER_BUCKET * rows /
max_group_rows`` rows per level.  Each is fetched once into a local relation
and broadcast when a row-count check against ``broadcast_max_rows`` passes;
beyond that it is checkpointed and joined with a shuffle join
(for the level-1 table, keyed by the hot keys themselves, that join then
relies on AQE's skew split; it takes over ``broadcast_max_rows`` hot keys
to get there).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.operators.dedup import latest_per_key
from ledgerlake.operators.normalize import normalize_loan_master
from ledgerlake.session import checkpoint_dir

SCD2_COLUMNS = [
    "loan_id", "customer_id", "loan_type", "origination_dt", "principal", "interest_rate",
    "term_months", "status", "branch_id", "valid_from", "valid_to", "is_current",
]

DEFAULT_MAX_GROUP_ROWS = 1_000_000
# A grid row is a key and a few numbers; 100,000 of them are a few megabytes.
DEFAULT_BROADCAST_MAX_ROWS = 100_000
# Sampled rows that stand for one full bucket, and fine bins per bucket.
SAMPLES_PER_BUCKET = 64
BINS_PER_BUCKET = 8
# Grid levels: a crowded bin (over half a bucket) is split again, over its own range.
LEVELS = 3
SAMPLE_SEED = 7


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def _checked(df: DataFrame, max_rows: int) -> tuple[DataFrame, bool, bool]:
    """Materialise a lookup table once; say whether it may be broadcast and whether it is empty.

    Up to ``max_rows`` rows are fetched in one job into a local relation (its
    exact size known to the planner); a larger table is persisted, then
    checkpointed to the cluster's checkpoint folder (lineage cut, computed
    once) and shuffle-joined.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) <= max_rows:
        return df.sparkSession.createDataFrame(rows, df.schema), True, not rows
    checkpoint_dir(df.sparkSession)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return df.checkpoint(eager=True), False, False
    finally:
        df.unpersist()


def key_sample(df: DataFrame, key: str, ts: str, max_group_rows: int) -> tuple[DataFrame, float]:
    """Bernoulli sample of ``(key, _t)`` (time in microseconds).

    Returns the sample and how many sampled rows stand for ``max_group_rows``
    real ones.  Small targets (tests) sample everything.
    """
    fraction = min(1.0, SAMPLES_PER_BUCKET / max_group_rows)
    base = df.select(key, _micros(F.col(ts)).alias("_t"))
    sample = base if fraction >= 1.0 else base.sample(fraction=fraction, seed=SAMPLE_SEED)
    return sample, max_group_rows * fraction


def _levels(n: int) -> list[str]:
    return [f"_f{i}" for i in range(1, n + 1)]


def _cells(sample: DataFrame, key: str, path: list[str], split_above: float, per_bucket: float) -> DataFrame:
    """Cells (key + bin path) holding over ``split_above`` sampled rows, with the grid to split them by.

    A cell is cut into ``BINS_PER_BUCKET`` equal-width bins per bucket's worth
    (``per_bucket`` sampled rows) of its rows, over its *own* sampled time
    range, so a far outlier in a parent cell does not widen the child grid.
    """
    return (
        sample.groupBy(key, *path)
        .agg(F.count(F.lit(1)).alias("_c"), F.min("_t").alias("_lo"), F.max("_t").alias("_hi"))
        .filter(F.col("_c") > F.lit(split_above))
        .select(
            key,
            *path,
            "_lo",
            (F.col("_hi") - F.col("_lo") + F.lit(1)).cast("double").alias("_span"),
            (F.ceil(F.col("_c") / F.lit(per_bucket)) * F.lit(BINS_PER_BUCKET)).cast("long").alias("_nbins"),
        )
    )


def fine_bin(t_micros: Column) -> Column:
    """Bin of a time (microseconds) in its cell's grid, clamped to the grid."""
    raw = F.floor((t_micros - F.col("_lo")).cast("double") / F.col("_span") * F.col("_nbins")).cast("long")
    return F.least(F.greatest(raw, F.lit(0).cast("long")), F.col("_nbins") - 1)


def assign_bins(df: DataFrame, grids: list[tuple[DataFrame, bool]], key: str, t_micros: Column) -> DataFrame:
    """Add ``_f1.._fL`` (the row's bin at each level, -1 below its leaf or for
    ordinary keys and NULL times) and ``_hot`` (the key has a level-1 grid)."""
    out = df
    for level, (grid, small) in enumerate(grids, 1):
        path = _levels(level - 1)
        out = out.join(F.broadcast(grid) if small else grid, [key, *path], "left")
        has_grid = F.col("_nbins").isNotNull()
        f = F.when(has_grid & t_micros.isNotNull(), fine_bin(t_micros)).otherwise(F.lit(-1).cast("long"))
        extra = {"_hot": has_grid} if level == 1 else {}
        out = out.withColumns({f"_f{level}": f, **extra}).drop("_lo", "_span", "_nbins")
    return out


def bucket_map(sample: DataFrame, grids: list[tuple[DataFrame, bool]], key: str, per_bucket: float) -> DataFrame:
    """``(key, _f1.._fL, _bkt)`` for every leaf bin of every hot key, empty leaves included.

    A leaf's bucket is the number of sampled rows in the key's earlier leaves
    (in time order) divided by one bucket's worth: buckets are balanced by
    count, not by time, and increase with time.
    """
    depth = len(grids)
    leaves = None
    for level, (grid, _) in enumerate(grids, 1):
        path = _levels(level - 1)
        bins = grid.select(key, *path, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_nbins") - 1)).alias(f"_f{level}"))
        if level < depth:  # a bin split at the next level is not a leaf
            nxt = grids[level][0].select(key, *_levels(level))
            bins = bins.join(nxt, [key, *_levels(level)], "left_anti")
        bins = bins.select(key, *_levels(level), *[F.lit(-1).cast("long").alias(c) for c in _levels(depth)[level:]])
        leaves = bins if leaves is None else leaves.unionByName(bins)
    path = _levels(depth)
    counts = assign_bins(sample, grids, key, F.col("_t")).drop("_hot").groupBy(key, *path).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(key).orderBy(*path).rowsBetween(Window.unboundedPreceding, -1))
    return leaves.join(counts, [key, *path], "left").fillna(0, ["_n"]).select(
        key, *path, F.floor(F.coalesce(before, F.lit(0)) / F.lit(per_bucket)).cast("long").alias("_bkt")
    )


def with_time_buckets(
    df: DataFrame,
    key: str,
    ts: str,
    max_group_rows: int = DEFAULT_MAX_GROUP_ROWS,
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Add ``_bucket`` and ``_hot``.

    Ordinary keys: bucket 0 for every row (NULL times included).  Hot keys:
    a count-balanced time range, -1 for NULL times.
    """
    return _bucketize(df, key, ts, max_group_rows, broadcast_max_rows)[0]


def partition_buckets(bucketed: DataFrame, key: str, any_hot: bool) -> DataFrame:
    """The one hash shuffle both windows reuse.

    Without hot keys ``_bucket`` is the constant 0, which the optimizer drops
    from window partition specs; shuffling on the key alone then satisfies
    them (a (key, 0) shuffle would not, and each window would shuffle again).
    """
    return bucketed.repartition(key, "_bucket") if any_hot else bucketed.repartition(key)


class TimeBuckets:
    """Grids and bucket map for the hot keys of an input, estimated from a sample.

    ``any_hot`` is False when no key is estimated over ``max_group_rows``
    rows; then every row gets bucket 0 and no lookup tables exist.
    """

    def __init__(self, source: DataFrame, key: str, ts: str, max_group_rows: int, broadcast_max_rows: int):
        self.key, self.ts = key, ts
        sample, per_bucket = key_sample(source, key, ts, max_group_rows)
        # Persisted, not checkpointed: one narrow scan of the input serves every
        # table below (a lost block is recomputed: the sample is seeded).
        sampled = sample.persist(StorageLevel.MEMORY_AND_DISK)
        sample = sampled.filter(F.col("_t").isNotNull())
        try:
            # Rows without a time get no grid, but a pile of them is a hot group too.
            piles = sampled.filter(F.col("_t").isNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
            self.null_pile = not piles.filter(F.col("_c") > F.lit(per_bucket)).isEmpty()
            self.grids: list[tuple[DataFrame, bool]] = []
            for level in range(1, LEVELS + 1):
                placed = sample
                if self.grids:  # deeper cells exist only inside a split parent
                    placed = assign_bins(sample, self.grids, key, F.col("_t")).drop("_hot").filter(
                        F.col(f"_f{level - 1}") >= 0
                    )
                # Level 1: keys over one bucket's rows; deeper: bins over half a bucket.
                split_above = per_bucket if level == 1 else per_bucket / 2
                cells = _cells(placed, key, _levels(level - 1), split_above, per_bucket)
                grid, small, empty = _checked(cells, broadcast_max_rows)
                if empty:  # no hot key, or no crowded bin at this level: the grid ends here
                    break
                self.grids.append((grid, small))
            self.any_hot = bool(self.grids)
            if self.any_hot:
                self.buckets, self.small, _ = _checked(bucket_map(sample, self.grids, key, per_bucket), broadcast_max_rows)
        finally:
            sampled.unpersist()

    def apply(self, df: DataFrame) -> DataFrame:
        """Add ``_bucket`` and ``_hot`` to ``df`` (rows of the same keys and times as the source)."""
        key, ts = self.key, self.ts
        if not self.any_hot:
            return df.withColumns({"_hot": F.lit(False), "_bucket": F.lit(0).cast("long")})
        placed = assign_bins(df, self.grids, key, _micros(F.col(ts)))
        path = _levels(len(self.grids))
        hot = F.col("_f1") >= 0  # hot key and a time
        if self.small:
            mapped = placed.join(F.broadcast(self.buckets), [key, *path], "left")
        else:
            # Shuffle-join only the hot rows; ordinary rows share the bin path
            # (-1, ...) and would all hash to one partition.
            cold = placed.filter(~hot).withColumn("_bkt", F.lit(None).cast("long"))
            mapped = cold.unionByName(placed.filter(hot).join(self.buckets, [key, *path], "left"))
        bucket = (
            F.when(~F.col("_hot"), F.lit(0).cast("long"))
            .when(F.col(ts).isNull(), F.lit(-1).cast("long"))
            .otherwise(F.col("_bkt"))
        )
        return mapped.withColumn("_bucket", bucket).drop(*path, "_bkt")


def _bucketize(
    df: DataFrame, key: str, ts: str, max_group_rows: int, broadcast_max_rows: int
) -> tuple[DataFrame, bool]:
    """``with_time_buckets`` plus whether any key is hot."""
    tb = TimeBuckets(df, key, ts, max_group_rows, broadcast_max_rows)
    return tb.apply(df), tb.any_hot


def lead_in_buckets(parted: DataFrame, key: str, ts: str, out: str, heads_from: DataFrame) -> DataFrame:
    """``lead(ts)`` per key on bucketed rows hash-partitioned by (key, _bucket).

    ``(key, ts)`` must be unique in ``parted``.  ``heads_from`` is the same
    rows *before* the shuffle (duplicates allowed).  Adds ``out``; drops
    ``_bucket`` and ``_hot``.
    """
    in_bucket = parted.withColumn(
        out, F.lead(ts).over(Window.partitionBy(key, "_bucket").orderBy(F.col(ts).asc_nulls_first()))
    )
    # One row per hot (key, bucket): its first time, and the next bucket's.
    # Computed before the shuffle from hot rows only (two columns, partial
    # aggregation): each map task sends one row per hot bucket.  Bucket -1
    # holds NULL times only and sorts first, so it is never "next".
    heads = heads_from.filter("_hot").groupBy(key, "_bucket").agg(F.min(ts).alias("_first"))
    nexts = heads.select(
        key, "_bucket", F.lead("_first").over(Window.partitionBy(key).orderBy("_bucket")).alias("_next")
    )
    patched = in_bucket.join(nexts, [key, "_bucket"], "left")
    return patched.withColumn(out, F.coalesce(F.col(out), F.col("_next"))).drop("_bucket", "_hot", "_next")


def lead_within_key(
    df: DataFrame,
    key: str,
    ts: str,
    out: str,
    max_group_rows: int = DEFAULT_MAX_GROUP_ROWS,
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Skew-safe ``lead(ts) over (partition by key order by ts nulls first)``; ``(key, ts)`` unique."""
    bucketed, any_hot = _bucketize(df, key, ts, max_group_rows, broadcast_max_rows)
    return lead_in_buckets(partition_buckets(bucketed, key, any_hot), key, ts, out, heads_from=bucketed)


def loan_master_scd2(
    bronze: DataFrame,
    max_group_rows: int = DEFAULT_MAX_GROUP_ROWS,
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Version history from bronze loan master rows (all extractions, duplicates allowed)."""
    typed = normalize_loan_master(bronze).withColumnRenamed("MODIFIED_TS", "valid_from")
    version_order = (F.col("_ingestion_ts").desc_nulls_last(),)
    tb = TimeBuckets(typed, "loan_id", "valid_from", max_group_rows, broadcast_max_rows)
    if not (tb.any_hot or tb.null_pile):
        # No loan over max_group_rows raw rows, so no pile of copies is either, with a time or without:
        # one shuffle on the loan serves the version dedup and lead.
        parted = tb.apply(typed).repartition("loan_id")
        versions = latest_per_key(parted, ("loan_id", "valid_from"), version_order)
        hist = lead_in_buckets(versions, "loan_id", "valid_from", "valid_to", heads_from=versions)
    else:
        # Exact versions first: the (loan, time) shuffle carries a partial
        # top-1 limit, so a pile of copies of one version is reduced in each
        # map task before it moves; then one shuffle on (loan, bucket) for lead.
        versions = latest_per_key(typed, ("loan_id", "valid_from"), version_order)
        bucketed = tb.apply(versions)
        hist = lead_in_buckets(partition_buckets(bucketed, "loan_id", tb.any_hot), "loan_id", "valid_from", "valid_to",
                               heads_from=bucketed)
    return hist.withColumn("is_current", F.col("valid_to").isNull()).select(*SCD2_COLUMNS)
