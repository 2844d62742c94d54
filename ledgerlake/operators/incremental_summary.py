"""The event summary kept up to date from changed rows, with exact distinct counts.

A distinct count cannot be updated from new rows alone: a value may have been
counted before, and a retracted row may or may not have been the last one with its value.
So two tables are kept beside the summary:

* counted values: (group, kind, value, n), how many rows of a group carry a
  loan, a customer or an event time;
* totals: (group, rows, amounts, total).

(``activity_measures`` are the columns of the activity that they need.)

A change is a set of activity rows with a sign: +1 for a row that came, -1 for
one that went (an event whose loan changed goes with its old attributes and
comes with its new ones).  Both tables are linear in the rows, so the changes' own
counts (``signed_counts``, ``signed_totals``: pre-aggregated before they are
shuffled) are simply added; only values and groups that occur in the changes get new
rows.  The summary changes only in the groups of the changes: their distinct
counts move by the values that appeared or vanished, which the changed values' old
and new counts tell; their first and last times are read again from the
group's counted times.  Nothing else of the activity is read.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import constants as K
from ledgerlake.operators.lineage import add_gold_lineage
from ledgerlake.schemas import DEC_AMOUNT, DEC_TOTAL, EVENT_SUMMARY_KEYS

COUNTED = [*EVENT_SUMMARY_KEYS, "kind", "value"]
KINDS = {"loan": "loan_id", "customer": "customer_id", "time": "event_ts"}


def activity_measures(activity: DataFrame) -> DataFrame:
    """The columns of activity rows that the summary depends on."""
    return activity.select(*EVENT_SUMMARY_KEYS, "amount", *KINDS.values())


def _same(a: DataFrame, b: DataFrame, names: list[str], prefix: str) -> tuple[DataFrame, Column]:
    """``b`` with its ``names`` prefixed, and the condition that they equal ``a``'s, NULLs included."""
    b = b.withColumnsRenamed({n: prefix + n for n in names})
    return b, reduce(lambda x, y: x & y, [a[n].eqNullSafe(b[prefix + n]) for n in names])


def signed_counts(changes: DataFrame, sign: str = "sign") -> DataFrame:
    """(group, kind, value, n) of activity rows with a sign; values whose rows cancel out are left out."""
    value = {k: (F.unix_micros(c) if k == "time" else F.col(c)).cast("string") for k, c in KINDS.items()}
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in value.items()]))
    rows = changes.select(*EVENT_SUMMARY_KEYS, sign, pairs.alias("p")).select(*EVENT_SUMMARY_KEYS, "p.*", sign).filter("value is not null")
    return rows.groupBy(*COUNTED).agg(F.sum(sign).cast("long").alias("n")).filter("n <> 0")


def signed_totals(changes: DataFrame, sign: str = "sign") -> DataFrame:
    """(group, rows, amounts, total) of activity rows with a sign."""
    amount = F.col("amount") * F.col(sign).cast("int")
    return changes.groupBy(*EVENT_SUMMARY_KEYS).agg(
        F.sum(sign).cast("long").alias("rows"),
        F.sum(F.when(F.col("amount").isNotNull(), F.col(sign)).otherwise(0)).cast("long").alias("amounts"),
        F.coalesce(F.sum(amount.cast(DEC_TOTAL)), F.lit(0)).cast(DEC_TOTAL).alias("total"),
    )


def add_changes(state: DataFrame, changes: DataFrame, keys: list[str], measures: list[str], alive: str) -> DataFrame:
    """``state`` with the measures of ``changes`` (one row per key) added; rows whose ``alive`` measure reaches zero go.

    The state is read once and not shuffled where AQE finds the changes small
    enough to broadcast; keys that are new come from an anti join.
    """
    other, same = _same(state, changes.withColumnsRenamed({m: f"_{m}" for m in measures}), keys, "_k_")
    kept = state.join(other, same, "left").select(
        *keys, *[(F.col(m) + F.coalesce(F.col(f"_{m}"), F.lit(0))).cast(state.schema[m].dataType).alias(m) for m in measures]
    )
    known, unseen = _same(changes, state.select(*keys), keys, "_s_")
    new = changes.join(known, unseen, "left_anti").select(*keys, *[F.col(m).cast(state.schema[m].dataType).alias(m) for m in measures])
    return kept.unionByName(new).filter(F.col(alive) > 0)


def add_counts(state: DataFrame, changes: DataFrame) -> DataFrame:
    return add_changes(state, changes, COUNTED, ["n"], "n")


def add_totals(state: DataFrame, changes: DataFrame) -> DataFrame:
    return add_changes(state, changes, EVENT_SUMMARY_KEYS, ["rows", "amounts", "total"], "rows")


def average(total: Column, n: Column) -> Column:
    """``total / n`` rounded half up to eight, then to four digits, as ``avg`` of a DECIMAL(18,4) gives it.

    The whole part is taken off first, so the division keeps 18 digits: exact for groups of up to 10**10 rows.
    """
    count = n.cast("decimal(20,0)")
    quotient = total / F.when(n > 0, count)
    whole = F.when(total < 0, F.ceil(quotient)).otherwise(F.floor(quotient)).cast("decimal(28,0)")
    rest = ((total - whole * count).cast("decimal(24,4)") / F.when(n > 0, count)).cast("decimal(22,8)")
    return (whole + rest).cast("decimal(22,8)").cast(DEC_AMOUNT)


def _measures(counts: DataFrame) -> DataFrame:
    """Distinct counts and times of each group of counted values."""
    is_kind = {k: F.col("kind") == k for k in KINDS}
    time = F.when(is_kind["time"], F.col("value").cast("long"))
    return counts.groupBy(*EVENT_SUMMARY_KEYS).agg(
        F.count_if(is_kind["loan"]).alias("distinct_loans"), F.count_if(is_kind["customer"]).alias("distinct_customers"),
        F.timestamp_micros(F.min(time)).alias("first_event_ts"), F.timestamp_micros(F.max(time)).alias("last_event_ts"),
    )


def _with_totals(totals: DataFrame, measures: DataFrame) -> DataFrame:
    measures, same = _same(totals, measures, EVENT_SUMMARY_KEYS, "_m_")
    return totals.join(measures, same, "left").select(
        *EVENT_SUMMARY_KEYS, F.col("rows").alias("event_count"), F.when(F.col("amounts") > 0, F.col("total")).cast(DEC_TOTAL).alias("total_amount"),
        average(F.col("total"), F.col("amounts")).alias("avg_amount"), F.coalesce("distinct_loans", F.lit(0)).alias("distinct_loans"),
        F.coalesce("distinct_customers", F.lit(0)).alias("distinct_customers"), "first_event_ts", "last_event_ts",
    )


def summary_of_state(totals: DataFrame, counts: DataFrame, run_ts: dt.datetime | str | None = None) -> DataFrame:
    """The whole event summary from the kept tables."""
    return add_gold_lineage(_with_totals(totals, _measures(counts)), K.JOB_GOLD_EVENTS, run_ts)


def refresh_summary(
    summary: DataFrame, totals: DataFrame, counts: DataFrame, d_totals: DataFrame, d_counts: DataFrame, run_ts: dt.datetime | str | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(summary, totals, counts) after the changes whose ``signed_totals`` and ``signed_counts`` are given.

    Rows of groups that the changes do not touch pass as they are, with the
    stamps of the run that made them.  Groups whose rows are all gone go.  Both
    signed tables are read several times: hand over written or checkpointed ones.
    """
    new_totals, new_counts = add_totals(totals, d_totals), add_counts(counts, d_counts)
    # a change that swaps rows alike in all that is summed leaves the group as it is
    touched = d_totals.filter("rows <> 0 or amounts <> 0 or total <> 0").select(*EVENT_SUMMARY_KEYS)
    touched = touched.unionByName(d_counts.select(*EVENT_SUMMARY_KEYS)).distinct()

    def of_touched(df: DataFrame, how: str) -> DataFrame:
        keys, same = _same(df, touched, EVENT_SUMMARY_KEYS, "_t_")
        return df.join(keys, same, how)

    renewed = summary_of_state(of_touched(new_totals, "left_semi"), of_touched(new_counts, "left_semi"), run_ts)
    return of_touched(summary, "left_anti").unionByName(renewed), new_totals, new_counts
