"""Bronze -> silver type normalisation (explicit column lists, null-on-failure casts)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import constants as K
from ledgerlake.functions import safe_cast, safe_date, safe_timestamp
from ledgerlake.schemas import SILVER_LOAN_EVENTS_COLUMNS, SILVER_LOAN_MASTER_COLUMNS


def _source(df: DataFrame, name: str) -> Column:
    """The input column, or a NULL when an older writer did not produce it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(T.StringType())


def normalize_loan_master(df: DataFrame) -> DataFrame:
    """Type the bronze loan master; malformed values become NULL.

    Only the business columns plus ``_ingestion_ts`` are kept: bronze
    partition directories (``year/month/day``) and provenance columns do not
    leak into silver.
    """
    special = {
        "origination_dt": lambda c: safe_date(c, K.ORIGINATION_DT_FORMAT),
        "MODIFIED_TS": lambda c: F.coalesce(safe_timestamp(c, K.MODIFIED_TS_FORMAT), safe_timestamp(c)),
        "_ingestion_ts": lambda c: safe_timestamp(c),
    }
    cols = []
    for name, dtype in SILVER_LOAN_MASTER_COLUMNS:
        src = _source(df, name)
        typed = special[name](src) if name in special else safe_cast(src, dtype)
        cols.append(typed.alias(name))
    return df.select(*cols)


def normalize_loan_events(df: DataFrame) -> DataFrame:
    """Type the bronze loan events; ISO-8601 timestamps with offsets parse to UTC instants.

    Events from older producers lack ``loan_type``/``status``; they come out NULL.
    """
    cols = []
    for name, dtype in SILVER_LOAN_EVENTS_COLUMNS:
        src = _source(df, name)
        typed = safe_timestamp(src) if isinstance(dtype, T.TimestampType) else safe_cast(src, dtype)
        cols.append(typed.alias(name))
    return df.select(*cols)
