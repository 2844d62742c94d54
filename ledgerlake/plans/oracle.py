"""Independent SQL oracle (DuckDB dialect) for every registered query.

Each entry is one statement over the pre-registered views ``orders`` and
``events``: the fixture derivations become CTEs, followed by the layer
logic written directly in SQL.  Spark and DuckDB must agree value for value
(column names included) on the same parquet tables.
"""

from __future__ import annotations

from ledgerlake import constants as K
from ledgerlake import fixtures as X

_RUN_TS = f"timestamp '{X.RUN_TS}'"
_AS_OF = f"date '{X.AS_OF}'"
_WM = f"timestamp '{X.INCREMENT_WATERMARK}'"


def _dims() -> str:
    status = ",\n    ".join(
        f"({k}, '{s}', '{o}', cast({lgd} as decimal(5,4)), '{d}')" for k, s, o, lgd, d in K.STATUS_ROWS
    )
    loan_type = ",\n    ".join(
        f"({k}, '{t}', '{c}', '{col}', {str(flag).lower()})" for k, t, c, col, flag in K.LOAN_TYPE_ROWS
    )
    return f"""dim_status as (
  select * from (values
    {status}
  ) t(status_key, status, occ_classification, loss_given_default, description)
),
dim_loan_type as (
  select * from (values
    {loan_type}
  ) t(loan_type_key, loan_type, category, collateral_type, real_estate_flag)
)"""


_MASTER_NORMALIZED = """master_normalized as (
  select
    cast(loan_id as varchar) as loan_id,
    cast(customer_id as varchar) as customer_id,
    cast(loan_type as varchar) as loan_type,
    cast(try_strptime(cast(origination_dt as varchar), '%Y-%m-%d') as date) as origination_dt,
    try_cast(principal as decimal(18,4)) as principal,
    try_cast(interest_rate as decimal(8,4)) as interest_rate,
    try_cast(term_months as integer) as term_months,
    cast(status as varchar) as status,
    cast(branch_id as varchar) as branch_id,
    try_strptime(cast(MODIFIED_TS as varchar), '%Y-%m-%d %H:%M:%S') as MODIFIED_TS,
    try_cast(_ingestion_ts as timestamp) as _ingestion_ts
  from bronze_loan_master
)"""

_EVENTS_NORMALIZED = """events_normalized as (
  select
    cast(loan_id as varchar) as loan_id,
    cast(customer_id as varchar) as customer_id,
    cast(event_type as varchar) as event_type,
    try_cast(amount as decimal(18,4)) as amount,
    cast(currency as varchar) as currency,
    cast(loan_type as varchar) as loan_type,
    cast(status as varchar) as status,
    cast(account_number as varchar) as account_number,
    try_cast(event_ts as timestamp) as event_ts,
    try_cast(_ingestion_ts as timestamp) as _ingestion_ts,
    try_cast(_partition as integer) as _partition,
    try_cast(_offset as bigint) as _offset
  from bronze_loan_events
)"""

_MASTER_SILVER = f"""loan_master_silver as (
  select *, {_RUN_TS} as _silver_ts, '{K.JOB_SILVER_MASTER}' as _silver_job, 'bronze' as _source_layer
  from master_normalized
  qualify row_number() over (
    partition by loan_id order by MODIFIED_TS desc nulls last, _ingestion_ts desc nulls last) = 1
)"""

_EVENTS_SILVER = f"""loan_events_silver as (
  select *, {_RUN_TS} as _silver_ts, '{K.JOB_SILVER_EVENTS}' as _silver_job, 'bronze' as _source_layer
  from events_normalized
  qualify row_number() over (
    partition by loan_id, event_ts, event_type
    order by _ingestion_ts desc nulls last, _partition desc nulls last, _offset desc nulls last) = 1
)"""

_FACT_PERF = f"""fact_loan_performance as (
  select
    m.loan_id, m.customer_id, lt.loan_type_key, st.status_key,
    m.loan_type, m.status, st.occ_classification,
    m.origination_dt, {_AS_OF} as report_dt, m.principal,
    case when m.status in ('PAID_OFF', 'CHARGED_OFF') then cast(0 as decimal(18,4)) else m.principal end
      as estimated_balance,
    m.interest_rate, m.term_months,
    cast(m.term_months - datesub('month', m.origination_dt, {_AS_OF}) as integer) as months_remaining,
    coalesce(m.status in ('DELINQUENT', 'DEFAULT'), false) as is_delinquent,
    st.loss_given_default,
    cast((case when m.status in ('PAID_OFF', 'CHARGED_OFF') then cast(0 as decimal(18,4)) else m.principal end)
      * st.loss_given_default as decimal(18,4)) as risk_weighted_exposure,
    m.branch_id, m.MODIFIED_TS,
    '{K.JOB_GOLD_MASTER}' as _gold_job, {_RUN_TS} as _gold_ts
  from loan_master_silver m
  left join dim_loan_type lt on m.loan_type = lt.loan_type
  left join dim_status st on m.status = st.status
)"""

_FACT_ACTIVITY = f"""fact_loan_event_activity as (
  select
    e.loan_id, e.customer_id, e.event_type,
    e.event_ts, cast(e.event_ts as date) as event_date,
    cast(year(e.event_ts) as integer) as event_year, cast(month(e.event_ts) as integer) as event_month,
    e.amount, e.currency,
    lt.loan_type_key, m.loan_type, lt.category, lt.collateral_type,
    st.status_key, m.status as current_status, st.occ_classification,
    m.principal, m.interest_rate, m.term_months,
    m.branch_id, m.origination_dt,
    coalesce(e.event_type in ('MISSED_PAYMENT', 'DELINQUENCY', 'STATUS_CHANGE'), false) as is_adverse,
    coalesce(e.event_type in ('PAYMENT', 'PAYOFF'), false) as payment_flag,
    e._partition, e._offset,
    '{K.JOB_GOLD_EVENTS}' as _gold_job, {_RUN_TS} as _gold_ts
  from loan_events_silver e
  left join loan_master_silver m on e.loan_id = m.loan_id
  left join dim_loan_type lt on m.loan_type = lt.loan_type
  left join dim_status st on m.status = st.status
)"""

def _half_up_div(num: str, den: str) -> str:
    """Integer ``round_half_up(num / den)`` for non-negative integers."""
    return f"(({num}) * 2 + ({den})) // (2 * ({den}))"


# avg is computed exactly as Spark does for DECIMAL(18,4): sum / count rounded
# half-up to 8 decimals, then half-up to 4 (amounts are never negative here).
# DuckDB's own avg(DECIMAL) is a DOUBLE and may round a tie the other way.
_AVG8 = _half_up_div("cast(sum(amount * 10000) as hugeint) * 10000", "nullif(count(amount), 0)")
_AVG4 = _half_up_div(_AVG8, "10000")

_SUMMARY = f"""fact_event_summary as (
  select
    event_type, loan_type_key, loan_type, status_key, branch_id, event_year, event_month, is_adverse,
    count(*) as event_count,
    cast(sum(amount) as decimal(38,4)) as total_amount,
    cast(cast({_AVG4} as decimal(18,0)) * 0.0001 as decimal(18,4)) as avg_amount,
    count(distinct loan_id) as distinct_loans,
    count(distinct customer_id) as distinct_customers,
    min(event_ts) as first_event_ts,
    max(event_ts) as last_event_ts,
    '{K.JOB_GOLD_EVENTS}' as _gold_job, {_RUN_TS} as _gold_ts
  from fact_loan_event_activity
  group by event_type, loan_type_key, loan_type, status_key, branch_id, event_year, event_month, is_adverse
)"""

# Percent with two decimals, exact half-up (DuckDB's decimal division is a DOUBLE).
_DELINQ_RATE = _half_up_div("cast(count(*) filter (where is_delinquent) as hugeint) * 10000", "count(*)")
_DELINQUENCY = f"""select loan_type,
  count(*) as total_loans,
  count(*) filter (where is_delinquent) as delinquent_loans,
  cast(cast({_DELINQ_RATE} as decimal(18,0)) * 0.01 as decimal(5,2)) as delinquency_rate
from fact_loan_performance
group by loan_type
order by delinquency_rate desc nulls last"""

_VERSIONS = """scd2_versions as (
  select * from master_normalized
  qualify row_number() over (partition by loan_id, MODIFIED_TS order by _ingestion_ts desc nulls last) = 1
)"""


# Times of the source in all their forms: the clock time less its offset; NULL if it does not parse.
_SOURCE = f"""source_loan_master as (
{X.SOURCE_LOAN_MASTER_SQL.format(master="bronze_loan_master").strip()}
),
source_timed as (
  select *, try_cast(MODIFIED_TS as timestamp)
    - case when regexp_matches(MODIFIED_TS, '[+-][0-9]{{2}}:[0-9]{{2}}$') then
        (case when substr(MODIFIED_TS, -6, 1) = '-' then -1 else 1 end)
        * to_minutes(60 * cast(substr(MODIFIED_TS, -5, 2) as integer) + cast(substr(MODIFIED_TS, -2) as integer))
      else to_minutes(0) end as t
  from source_loan_master
)"""
_SOURCE_COLUMNS = "loan_id, customer_id, loan_type, origination_dt, principal, interest_rate, term_months, status, branch_id, MODIFIED_TS"


def _with(*ctes: str) -> str:
    return "with " + X.oracle_bronze_ctes() + ",\n" + ",\n".join(ctes) + "\n"


_SILVER_CHAIN = (_MASTER_NORMALIZED, _EVENTS_NORMALIZED, _MASTER_SILVER, _EVENTS_SILVER)
_GOLD_CHAIN = _SILVER_CHAIN + (_dims(), _FACT_PERF, _FACT_ACTIVITY)


_HISTORY = (
    _with(_MASTER_NORMALIZED, _VERSIONS)
    + """select loan_id, customer_id, loan_type, origination_dt, principal, interest_rate, term_months,
  status, branch_id, MODIFIED_TS as valid_from,
  lead(MODIFIED_TS) over (partition by loan_id order by MODIFIED_TS asc nulls first) as valid_to,
  lead(MODIFIED_TS) over (partition by loan_id order by MODIFIED_TS asc nulls first) is null as is_current
from scd2_versions"""
)


def oracle_queries() -> dict[str, str]:
    return {
        "master_normalized": _with(_MASTER_NORMALIZED) + "select * from master_normalized",
        "incremental_extract": _with(_MASTER_NORMALIZED)
        + f"""select loan_id, customer_id, loan_type, origination_dt, principal, interest_rate, term_months,
  status, branch_id, MODIFIED_TS,
  '{K.SOURCE_TABLE}' as _source_table, '{K.SOURCE_SYSTEM}' as _source_system,
  strftime({_RUN_TS}, '%Y-%m-%d %H:%M:%S') as _ingestion_ts, '{X.INCREMENT_WATERMARK}' as _watermark_start
from bronze_loan_master
where coalesce(try_strptime(MODIFIED_TS, '%Y-%m-%d %H:%M:%S') > {_WM}, true)""",
        "next_watermark": _with(_MASTER_NORMALIZED)
        + f"""select max(ts) as next_watermark, count(*) as row_count
from (select try_strptime(MODIFIED_TS, '%Y-%m-%d %H:%M:%S') as ts from bronze_loan_master) s
where coalesce(ts > {_WM}, true)""",
        "loan_master_silver": _with(_MASTER_NORMALIZED, _MASTER_SILVER) + "select * from loan_master_silver",
        "events_normalized": _with(_EVENTS_NORMALIZED) + "select * from events_normalized",
        "loan_events_silver": _with(_EVENTS_NORMALIZED, _EVENTS_SILVER) + "select * from loan_events_silver",
        "dedup_metrics": _with(*_SILVER_CHAIN)
        + """select dataset, rows_in, rows_out, rows_in - rows_out as duplicates_removed from (
  select 'loan_master' as dataset, (select count(*) from bronze_loan_master) as rows_in,
         (select count(*) from loan_master_silver) as rows_out
  union all
  select 'loan_events', (select count(*) from bronze_loan_events), (select count(*) from loan_events_silver)
) t""",
        "fact_loan_performance": _with(*_GOLD_CHAIN) + "select * from fact_loan_performance",
        "fact_loan_event_activity": _with(*_GOLD_CHAIN) + "select * from fact_loan_event_activity",
        "fact_event_summary": _with(*_GOLD_CHAIN, _SUMMARY) + "select * from fact_event_summary",
        "event_type_totals": _with(*_GOLD_CHAIN, _SUMMARY)
        + """select event_type, cast(sum(event_count) as bigint) as total_events,
  cast(sum(total_amount) as decimal(38,4)) as total_volume
from fact_event_summary group by event_type order by event_type""",
        "risk_by_occ": _with(*_GOLD_CHAIN)
        + """select occ_classification, count(loan_id) as loan_count, cast(sum(risk_weighted_exposure) as decimal(38,2)) as total_risk_exposure
from fact_loan_performance group by all order by 3 desc nulls last, 1 nulls last""",
        "volume_by_event_type": _with(*_GOLD_CHAIN)
        + """select event_type, count(event_ts) as event_count, cast(sum(amount) as decimal(38,2)) as total_volume
from fact_loan_event_activity group by all order by 2 desc nulls last, 1 nulls last""",
        "delinquency_by_type": _with(*_GOLD_CHAIN) + _DELINQUENCY,
        "extract_bounded": _with(_SOURCE) + f"select {_SOURCE_COLUMNS} from source_timed where t is null or t > {_WM}",
        "extract_quarantined": _with(_SOURCE)
        + f"""select {_SOURCE_COLUMNS} from source_timed s where t > {_WM} or (t is null and not exists (
  select 1 from source_timed q where q.t is null and q.origination_dt <= '{X.INCREMENT_WATERMARK[:10]}'
    and row(q.loan_id, q.customer_id, q.loan_type, q.origination_dt, q.principal, q.interest_rate, q.term_months, q.status, q.branch_id)
      = row(s.loan_id, s.customer_id, s.loan_type, s.origination_dt, s.principal, s.interest_rate, s.term_months, s.status, s.branch_id)
    and q.MODIFIED_TS is not distinct from s.MODIFIED_TS))""",
        # Kept up to date from changed rows, the summary equals the full one.
        "event_summary_incremental": _with(*_GOLD_CHAIN, _SUMMARY) + "select * from fact_event_summary",
        # Incremental merge must equal the full rebuild.
        "merge_latest": _with(_MASTER_NORMALIZED, _MASTER_SILVER) + "select * from loan_master_silver",
        "loan_master_scd2": _HISTORY,
        # Three increments, one of them late, equal one build.
        "scd2_incremental": _HISTORY,
    }
