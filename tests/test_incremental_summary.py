from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerlake.operators import incremental_summary as S
from ledgerlake.operators.summary import event_summary

SCHEMA = (
    "event_type string, loan_type_key int, loan_type string, status_key int, branch_id string, event_year int, event_month int, is_adverse boolean, "
    "amount decimal(18,4), loan_id string, customer_id string, event_ts timestamp"
)


def activity(rng, n):
    out = []
    for _ in range(n):
        group = rng.choice([("PAYMENT", 1, "AUTO", 1, "B1", 2001, 7, False), ("PAYMENT", None, None, None, None, 2001, 7, False), ("DEFAULT", 2, "HELOC", 3, "B2", None, None, True)])
        amount = rng.choice([None, "0.0001", "0.0002", "-0.0001", "12345678901234.5678", "33.3333"])
        time = None if rng.random() < 0.2 else dt.datetime(2001, 7, rng.randint(1, 28))
        out.append((*group, amount, rng.choice([None, "L1", "L2", "L3"]), rng.choice([None, "C1", "C2"]), time))
    return out


def frame(spark, rows, sign=None):
    from decimal import Decimal

    rows = [(*r[:8], None if r[8] is None else Decimal(r[8]), *r[9:]) for r in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    return df if sign is None else df.withColumn("sign", F.lit(sign))


def test_refreshes_equal_the_rebuild_and_leave_other_groups_alone(spark):
    rng = random.Random(4)
    rows = activity(rng, 60)
    first = frame(spark, rows, 1)
    totals, counts = S.signed_totals(first), S.signed_counts(first)
    summary = S.summary_of_state(totals, counts, "2001-01-01 00:00:00")
    for step in range(2):
        gone = rng.sample(rows, 25)
        for r in gone:
            rows.remove(r)
        if step:  # a group vanishes
            gone += [r for r in rows if r[0] == "DEFAULT"]
            rows = [r for r in rows if r[0] != "DEFAULT"]
        came = [r for r in activity(rng, 15) if not (step and r[0] == "DEFAULT")]
        rows += came
        changes = frame(spark, came, 1).unionByName(frame(spark, gone, -1))
        d = [x.checkpoint() for x in (S.signed_totals(changes), S.signed_counts(changes))]
        summary, totals, counts = (x.checkpoint() for x in S.refresh_summary(summary, totals, counts, *d, f"2001-01-0{step + 2} 00:00:00"))
        want = event_summary(frame(spark, rows), "2001-01-01 00:00:00").drop("_gold_ts")
        got = summary.select(*want.columns)
        assert got.count() == want.count() and got.exceptAll(want).isEmpty()
        assert [t.dataType for t in got.schema] == [t.dataType for t in want.schema]
    # rows that go and come again change nothing: no value, no group, no stamp
    same = frame(spark, rows[:9], 1).unionByName(frame(spark, rows[:9], -1))
    d = S.signed_totals(same), S.signed_counts(same)
    assert d[1].isEmpty()
    assert S.refresh_summary(summary, totals, counts, *d, "2001-02-01 00:00:00")[0].exceptAll(summary).isEmpty()


def test_only_changed_values_are_written_anew(spark):
    rows = [("PAYMENT", 1, "AUTO", 1, "B1", 2001, 7, False, "1.0000", f"L{k}", f"C{k}", dt.datetime(2001, 7, 1)) for k in range(500)]
    one = [rows[7][:8] + ("2.0000", "L7", "C_new", dt.datetime(2001, 7, 2))]
    counts = S.signed_counts(frame(spark, rows, 1))
    delta = S.signed_counts(frame(spark, one, 1))
    assert delta.count() == 3  # a loan, a customer and a time
    after = S.add_counts(counts, delta)
    assert after.exceptAll(counts).count() == 3 and {(r.kind, r.value): r.n for r in after.filter("value in ('L7', 'C_new')").collect()} == {("loan", "L7"): 2, ("customer", "C_new"): 1}


def test_average_rounds_as_avg_does(spark):
    rng = random.Random(2)
    values = [[rng.choice([1, 2, 3, 5, -1, -5, 10**17 + 7]) for _ in range(rng.randint(1, 30))] for _ in range(300)]
    df = spark.createDataFrame([(g, v) for g, vs in enumerate(values) for v in vs], "g int, v long")
    df = df.select("g", (F.col("v") * F.lit(0.0001).cast("decimal(5,4)")).cast("decimal(18,4)").alias("a"))
    both = df.groupBy("g").agg(F.avg("a").cast("decimal(18,4)").alias("x"), S.average(F.sum("a"), F.count("a")).alias("y"))
    assert both.filter("x <> y or x is null or y is null").isEmpty() and both.count() == 300
