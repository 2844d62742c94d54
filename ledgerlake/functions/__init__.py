"""Column-level helpers: safe casts and business-rule expressions."""

from ledgerlake.functions.casts import safe_cast, safe_date, safe_timestamp
from ledgerlake.functions.expressions import (
    as_date,
    as_timestamp,
    estimated_balance,
    ingestion_partition_columns,
    is_adverse,
    is_delinquent,
    months_remaining,
    payment_flag,
    risk_weighted_exposure,
)

__all__ = [
    "safe_cast", "safe_date", "safe_timestamp", "as_date", "as_timestamp",
    "estimated_balance", "ingestion_partition_columns", "is_adverse", "is_delinquent",
    "months_remaining", "payment_flag", "risk_weighted_exposure",
]
