"""Derivation of the loan tables from the driver's generic tables.

The test data has no loan tables, so bronze loan master and bronze loan
events are derived from ``orders`` and ``events``.  The SQL text below is
written so that Spark SQL and DuckDB parse it unchanged; ``{orders}`` and
``{events}`` are placeholders: Spark binds DataFrames to them
(``spark.sql(text, orders=df)``), the SQL oracle substitutes view names.

Keys are padded, never cut: at any scale factor one order is one loan, and an
event without a loan has a prefix that no loan has.

The derivation deliberately contains several versions per loan, exact
timestamp ties, a status outside the dimension, events with no loan, and
redelivered events, so every silver and gold rule is exercised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BRONZE_LOAN_MASTER_SQL = """
with v as (
  select *, o_orderdate as mts, 0 as shift, '2001-09-01 00:00:00' as ing from {orders}
  union all
  select *, o_orderdate + interval 30 day, 1, '2001-09-02 00:00:00' from {orders} where o_orderkey % 7 = 0
  union all
  select *, o_orderdate, 0, '2001-09-03 00:00:00' from {orders} where o_orderkey % 13 = 0
)
select
  concat('L', case when o_orderkey >= 1000000 then cast(o_orderkey as string) else lpad(cast(o_orderkey as string), 7, '0') end) as loan_id,
  concat('C', case when o_custkey >= 10000 then cast(o_custkey as string) else lpad(cast(o_custkey as string), 5, '0') end) as customer_id,
  case o_orderpriority when '1-URGENT' then 'MORTGAGE' when '2-HIGH' then 'AUTO' when '3-MEDIUM' then 'PERSONAL'
    when '4-NOT SPECIFIED' then 'HELOC' else 'STUDENT' end as loan_type,
  cast(cast(o_orderdate as date) as string) as origination_dt,
  o_totalprice as principal,
  cast(2.5 as double) + cast(o_orderkey % 601 as double) / cast(100 as double) as interest_rate,
  cast(case o_orderkey % 5 when 0 then 60 when 1 then 120 when 2 then 180 when 3 then 240 else 360 end as bigint) as term_months,
  case when o_orderkey % 97 = 0 then 'UNDER_REVIEW'
    else case (o_orderkey + shift) % 5 when 0 then 'CURRENT' when 1 then 'DELINQUENT' when 2 then 'DEFAULT'
      when 3 then 'PAID_OFF' else 'CHARGED_OFF' end end as status,
  concat('BR', lpad(cast(o_custkey % 1000 as string), 3, '0')) as branch_id,
  cast(mts as string) as MODIFIED_TS,
  ing as _ingestion_ts
from v
"""

BRONZE_LOAN_EVENTS_SQL = """
with v as (
  select *, event_id as off from {events}
  union all
  select *, event_id + 1000000 from {events} where event_id % 9 = 0
)
select
  case when event_id % 4 = 0 then concat('X', cast(user_id as string))
    else concat('L', case when user_id >= 1000000 then cast(user_id as string) else lpad(cast(user_id as string), 7, '0') end) end as loan_id,
  concat('C', lpad(cast(user_id % 100 as string), 5, '0')) as customer_id,
  case event_type when 'view' then 'MISSED_PAYMENT' when 'signup' then 'ORIGINATION' when 'error' then 'DELINQUENCY'
    when 'click' then 'STATUS_CHANGE' else case when event_id % 3 = 0 then 'PAYOFF' else 'PAYMENT' end end as event_type,
  value as amount,
  'USD' as currency,
  case event_id % 3 when 0 then 'AUTO' when 1 then 'HELOC' else 'STUDENT' end as loan_type,
  case event_id % 2 when 0 then 'CURRENT' else 'DEFAULT' end as status,
  concat('AC', cast(user_id as string)) as account_number,
  concat(replace(cast(ts as string), ' ', 'T'), '+00:00') as event_ts,
  concat(replace(cast(ts as string), ' ', 'T'), '+00:00') as _ingestion_ts,
  cast(event_id % 3 as bigint) as _partition,
  off as _offset
from v
"""

# The same source with times as sources write them: with T, fractions, offsets, dates alone,
# and times that do not parse or are missing.  The form depends on the loan alone, so all versions of a loan share it.
SOURCE_LOAN_MASTER_SQL = """
select loan_id, customer_id, loan_type, origination_dt, principal, interest_rate, term_months, status, branch_id,
  case cast(substr(loan_id, 2) as bigint) % 11
    when 0 then concat(replace(MODIFIED_TS, ' ', 'T'), '.250')
    when 1 then concat(MODIFIED_TS, '+05:30')
    when 2 then concat(replace(MODIFIED_TS, ' ', 'T'), 'Z')
    when 3 then concat(MODIFIED_TS, '.500000-08:00')
    when 4 then substr(MODIFIED_TS, 1, 10)
    when 5 then concat('n/a ', MODIFIED_TS)
    when 6 then null
    when 7 then concat(substr(MODIFIED_TS, 1, 5), '13-45 00:00:00')
    else MODIFIED_TS end as MODIFIED_TS
from {master}
"""

# Fixed test parameters: an as-of date where Spark's months_between and a
# plain calendar-month difference agree, and an extraction watermark.
AS_OF = "2001-12-15"
RUN_TS = "2001-12-15 06:00:00"
INCREMENT_WATERMARK = "2001-07-15 00:00:00"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


ORDERS_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"]
EVENTS_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]


def bronze_loan_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze loan master (source-typed: text dates, double amounts)."""
    orders = read_table(spark, sf_dir, "orders", ORDERS_COLUMNS)
    return spark.sql(BRONZE_LOAN_MASTER_SQL, orders=orders)


def bronze_loan_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze loan events (JSON-typed: ISO text timestamps, double amounts)."""
    events = read_table(spark, sf_dir, "events", EVENTS_COLUMNS)
    return spark.sql(BRONZE_LOAN_EVENTS_SQL, events=events)


def source_loan_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source's loan master, with times in many forms."""
    rows = spark.sql(SOURCE_LOAN_MASTER_SQL, master=bronze_loan_master(spark, sf_dir).drop("_ingestion_ts"))
    # A stored column, as far as the optimizer is concerned: its CASE is not copied into every use of it.
    return rows.withColumn("MODIFIED_TS", F.explode(F.array("MODIFIED_TS")))


def oracle_bronze_ctes() -> str:
    """The same derivations as DuckDB CTEs over the pre-registered views."""
    master = BRONZE_LOAN_MASTER_SQL.format(orders="orders").strip()
    events = BRONZE_LOAN_EVENTS_SQL.format(events="events").strip()
    return f"bronze_loan_master as (\n{master}\n),\nbronze_loan_events as (\n{events}\n)"
