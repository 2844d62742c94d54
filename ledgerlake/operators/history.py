"""Increments merged into the loan history (SCD type 2) without rebuilding it.

A history row is a version's interval [valid_from, valid_to).  A new version, late
or not, falls into one interval of its loan (or before all of them), and only that
interval and the versions new with it decide what changes:

* the interval's row ends where the first new version in it starts;
* each new version ends where the next new one starts, or where the interval ended;
* a version that the history has already takes the attributes of the newer ingestion.

So the merge looks up the covering interval of each new version, and yields
*patches* of present rows and new rows.  Of the history only the
increment's loans are looked at, in four columns, and
only patched rows are rewritten.  A version without a time starts before all others
(``valid_from`` NULL), as in the full build.

The next new version of a loan comes from ``lead_within_key``, which splits hot
loans; least(next new version, end of the interval) is the version's end, as a new
version of a later interval starts no earlier than this one ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.dedup import latest_per_key
from ledgerlake.operators.scd2 import SCD2_COLUMNS, lead_within_key

KEY = ("loan_id", "valid_from")
#: The history as kept: the public columns, and the ingestion that decides between copies of a version.
HISTORY_COLUMNS = [*SCD2_COLUMNS, "_ingestion_ts"]
ATTRIBUTES = [c for c in HISTORY_COLUMNS if c not in (*KEY, "valid_to", "is_current")]


def versions_of(typed: DataFrame) -> DataFrame:
    """Distinct versions of normalized loan master rows: of copies the latest ingestion."""
    typed = typed.withColumnRenamed("MODIFIED_TS", "valid_from")
    return latest_per_key(typed, KEY, (F.col("_ingestion_ts").desc_nulls_last(),)).select(*KEY, *ATTRIBUTES)


def covering(versions: DataFrame, history: DataFrame) -> DataFrame:
    """``versions`` with the interval that each falls into: _from, _to, _seen (its ingestion), _found.

    Before a loan's first version there is none (_found NULL); _to is then the first version's time.

    The interval is the loan's last one that starts no later.  It is looked up
    without comparing pairs: the starts of the loan's intervals and the new versions are
    sorted together by day, and a day's versions before its first start take
    the last start of the days before (one row for a loan and day).  So a loan that holds
    a third of all rows is spread over its days, and the work is that of a sort.
    """
    interval = F.struct(F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"), F.col("_ingestion_ts").alias("_seen"), F.lit(True).alias("_found"))
    loans = versions.select(F.col("loan_id").alias("_loan")).distinct()
    starts = history.join(loans, history["loan_id"].eqNullSafe(loans["_loan"]), "left_semi")
    starts = starts.select("loan_id", F.col("valid_from").alias("_at"), F.lit(0).alias("_kind"), interval.alias("_i"), F.lit(None).cast(_row_type(versions)).alias("_v"))
    new = versions.select("loan_id", F.col("valid_from").alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(starts.schema["_i"].dataType).alias("_i"), F.struct(*versions.columns).alias("_v"))
    both = starts.unionByName(new).withColumn("_day", F.to_date("_at"))
    in_day = Window.partitionBy("loan_id", "_day").orderBy(F.col("_at").asc_nulls_first(), "_kind").rowsBetween(Window.unboundedPreceding, 0)
    placed = both.withColumn("_here", F.last("_i", ignorenulls=True).over(in_day)).filter("_kind = 1").select("loan_id", "_day", "_v", "_here")
    days = both.groupBy("loan_id", "_day").agg(F.max_by("_i", F.when(F.col("_kind") == 0, F.struct("_at"))).alias("_last"))
    earlier = Window.partitionBy("loan_id").orderBy(F.col("_day").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    days = days.select(F.col("loan_id").alias("_l"), F.col("_day").alias("_d"), F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
    carried = placed.join(days, placed["loan_id"].eqNullSafe(days["_l"]) & placed["_day"].eqNullSafe(days["_d"]), "left")
    found = carried.select("_v.*", F.coalesce("_here", "_before").alias("_i")).select(*versions.columns, "_i.*")
    # A loan's first version: the end of the versions before it.
    first = starts.groupBy("loan_id").agg(F.min("_at").alias("_first")).withColumnRenamed("loan_id", "_loan")
    out = found.join(first, found["loan_id"].eqNullSafe(first["_loan"]), "left")
    return out.withColumn("_to", F.when(F.col("_found"), F.col("_to")).otherwise(F.col("_first"))).drop("_loan", "_first")


def _row_type(df: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])


def history_changes(located: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new rows, patches) from versions with their covering intervals (``covering``; read several times).

    Patches have the key of a present row, _end (its new end) and _new (its new attributes), each NULL where that stays.
    """
    known = F.col("_found") & F.col("_from").eqNullSafe(F.col("valid_from"))
    new = located.filter(~F.coalesce(known, F.lit(False)))
    chained = lead_within_key(new, "loan_id", "valid_from", "_then")
    ends = F.least("_then", "_to")  # least() leaves NULLs out
    rows = chained.withColumn("valid_to", ends).withColumn("is_current", ends.isNull()).select(*HISTORY_COLUMNS)
    closed = new.filter("_found").groupBy("loan_id", F.col("_from").alias("valid_from")).agg(F.min("valid_from").alias("_end"))
    closed = closed.select(*KEY, "_end", F.lit(None).cast(located.select(F.struct(*ATTRIBUTES).alias("a")).schema["a"].dataType).alias("_new"))
    newer = F.col("_seen").isNull() | (F.col("_ingestion_ts") > F.col("_seen"))
    replaced = located.filter(known & newer).select(*KEY, F.lit(None).cast("timestamp").alias("_end"), F.struct(*ATTRIBUTES).alias("_new"))
    patches = closed.unionByName(replaced).groupBy(*KEY).agg(F.min("_end").alias("_end"), F.max_by("_new", F.col("_new").isNotNull()).alias("_new"))
    return rows, patches


def apply_changes(history: DataFrame, rows: DataFrame, patches: DataFrame) -> DataFrame:
    """``history`` with its patched rows and the new ones."""
    patch = patches.withColumnsRenamed({"loan_id": "_loan", "valid_from": "_at"})
    same = history["loan_id"].eqNullSafe(patch["_loan"]) & history["valid_from"].eqNullSafe(patch["_at"])
    both = history.join(patch, same, "left")
    ends = F.coalesce("_end", "valid_to")
    patched = both.select(
        "loan_id", *[F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in ATTRIBUTES if c != "loan_id"],
        "valid_from", ends.alias("valid_to"), ends.isNull().alias("is_current"),
    )
    return patched.select(*HISTORY_COLUMNS).unionByName(rows.select(*HISTORY_COLUMNS))


def merge_history(history: DataFrame, typed: DataFrame) -> DataFrame:
    """The history after normalized loan master rows (``typed``; copies allowed), equal to a full build of all rows."""
    located = covering(versions_of(typed), history).checkpoint()
    return apply_changes(history, *history_changes(located))
