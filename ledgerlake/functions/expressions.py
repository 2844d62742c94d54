"""Business-rule column expressions used by the gold facts.

All are built-in Catalyst expressions (no UDFs), so they fuse into the
surrounding whole-stage-codegen span.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import constants as K
from ledgerlake.schemas import DEC_AMOUNT


def as_date(value: dt.date | str) -> Column:
    """A DATE literal from a date or ISO text."""
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value).cast(T.DateType())


def as_timestamp(value: dt.datetime | str) -> Column:
    """A TIMESTAMP literal (session time zone) from a datetime or ISO text."""
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ", timespec="microseconds")
    return F.lit(value).cast(T.TimestampType())


def months_remaining(term_months: Column, origination_dt: Column, as_of: Column) -> Column:
    """Term minus whole months elapsed; truncates toward zero, may be negative."""
    return term_months - F.months_between(as_of, origination_dt).cast(T.IntegerType())


def estimated_balance(status: Column, principal: Column) -> Column:
    """Zero for paid-off/charged-off loans, else principal (exact decimal)."""
    zero = F.lit(0).cast(DEC_AMOUNT)
    return F.when(status.isin(*K.ZERO_BALANCE_STATUSES), zero).otherwise(principal).cast(DEC_AMOUNT)


def is_one_of(value: Column, members: tuple[str, ...]) -> Column:
    """Membership that is false, not NULL, for a NULL value."""
    return F.coalesce(value.isin(*members), F.lit(False))


def is_delinquent(status: Column) -> Column:
    return is_one_of(status, K.DELINQUENT_STATUSES)


def risk_weighted_exposure(balance: Column, lgd: Column) -> Column:
    """Balance x loss given default, exact decimal, DECIMAL(18,4)."""
    return (balance * lgd).cast(DEC_AMOUNT)


def is_adverse(event_type: Column) -> Column:
    return is_one_of(event_type, K.ADVERSE_EVENT_TYPES)


def payment_flag(event_type: Column) -> Column:
    return is_one_of(event_type, K.PAYMENT_EVENT_TYPES)


def ingestion_partition_columns(ts: Column, with_hour: bool = False) -> dict[str, Column]:
    """Zero-padded ``year/month/day[/hour]`` directory values of an ingestion time."""
    cols = {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
    }
    if with_hour:
        cols["hour"] = F.date_format(ts, "HH")
    return cols
