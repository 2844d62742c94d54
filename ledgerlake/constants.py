"""Fixed domain values.

Everything in the "fixed values" block must stay equal to the values the
source platform uses, or gold results change meaning (OCC classes, loss
given default, category flags, event groupings, job names, default
watermark).  They are stated once here and used everywhere else.
"""

from __future__ import annotations

from decimal import Decimal

# ---------------------------------------------------------------------------
# Fixed values (must equal the source platform's)
# ---------------------------------------------------------------------------

# dim_status rows: status_key, status, occ_classification, loss_given_default, description
STATUS_ROWS = [
    (1, "CURRENT", "Pass", Decimal("0.00"), "Performing — no credit concern"),
    (2, "DELINQUENT", "Special Mention", Decimal("0.05"), "30-89 days past due"),
    (3, "DEFAULT", "Substandard", Decimal("0.20"), "90+ days past due"),
    (4, "PAID_OFF", "Pass", Decimal("0.00"), "Loan fully repaid"),
    (5, "CHARGED_OFF", "Loss", Decimal("1.00"), "Written off — unrecoverable"),
]

# dim_loan_type rows: loan_type_key, loan_type, category, collateral_type, real_estate_flag
LOAN_TYPE_ROWS = [
    (1, "MORTGAGE", "Real Estate", "Secured", True),
    (2, "AUTO", "Consumer", "Secured", False),
    (3, "PERSONAL", "Consumer", "Unsecured", False),
    (4, "HELOC", "Real Estate", "Secured", True),
    (5, "STUDENT", "Consumer", "Unsecured", False),
]

# Statuses whose balance is treated as zero for exposure.
ZERO_BALANCE_STATUSES = ("PAID_OFF", "CHARGED_OFF")
# Statuses counted as delinquent.
DELINQUENT_STATUSES = ("DELINQUENT", "DEFAULT")
# Event types flagged adverse / payment.
ADVERSE_EVENT_TYPES = ("MISSED_PAYMENT", "DELINQUENCY", "STATUS_CHANGE")
PAYMENT_EVENT_TYPES = ("PAYMENT", "PAYOFF")

# Default extraction high-water mark when no state exists.
DEFAULT_WATERMARK = "2000-01-01 00:00:00"

# Source identity written into bronze provenance columns.
SOURCE_TABLE = "loan_master"
SOURCE_SYSTEM = "us-east-1"
EVENT_TOPIC = "loan-events-raw"

SOURCE_LAYER_BRONZE = "bronze"

# ---------------------------------------------------------------------------
# Our own naming (not fixed by the source platform)
# ---------------------------------------------------------------------------

# Job names written into lineage columns.
JOB_SILVER_MASTER = "ledgerlake-silver-loan-master"
JOB_SILVER_EVENTS = "ledgerlake-silver-loan-events"
JOB_GOLD_MASTER = "ledgerlake-gold-loan-master"
JOB_GOLD_EVENTS = "ledgerlake-gold-loan-events"

# Text formats of the source system.
MODIFIED_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
ORIGINATION_DT_FORMAT = "yyyy-MM-dd"
