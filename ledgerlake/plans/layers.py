"""Layer builders: whole silver and gold tables as lazy DataFrame plans.

These compose the operators; they do no I/O, so pipelines, streaming
micro-batches, tests and benchmarks share exactly one definition.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import constants as K
from ledgerlake.operators.dedup import EVENT_KEYS, event_order, MASTER_KEYS, master_order, latest_per_key
from ledgerlake.operators.lineage import add_silver_lineage
from ledgerlake.operators.normalize import normalize_loan_events, normalize_loan_master
from ledgerlake.sources.bronze import CORRUPT_COLUMN, CORRUPT_VALUE_COLUMN


def silver_loan_master(bronze: DataFrame, run_ts: dt.datetime | str | None = None) -> DataFrame:
    """Typed, one row per loan (latest version), with silver lineage."""
    latest = latest_per_key(normalize_loan_master(bronze), MASTER_KEYS, master_order())
    return add_silver_lineage(latest, K.JOB_SILVER_MASTER, run_ts)


def decodable(bronze: DataFrame) -> DataFrame:
    """Bronze event rows whose line and payload both parsed; the rest stay in bronze only."""
    for c in (CORRUPT_COLUMN, CORRUPT_VALUE_COLUMN):
        if c in bronze.columns:
            bronze = bronze.filter(F.col(c).isNull())
    return bronze


def silver_loan_events(bronze: DataFrame, run_ts: dt.datetime | str | None = None) -> DataFrame:
    """Typed, one row per event identity (latest delivery), with silver lineage."""
    latest = latest_per_key(normalize_loan_events(decodable(bronze)), EVENT_KEYS, event_order())
    return add_silver_lineage(latest, K.JOB_SILVER_EVENTS, run_ts)
