"""Run settings (thresholds, names, fixed vocabularies) as one frozen value."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

# --- Fixed values: these must equal the source system's for equal results ---
# Source header -> canonical column (headers are trimmed first).
SOURCE_COLUMN_MAP = {
    "Customer ID": "customer_id",
    "TransactionID": "transaction_id",
    "Transaction Date": "transaction_date",
    "Transaction Amount": "transaction_amount",
    "Transaction Type": "transaction_type",
    "Account Type": "account_type",
    "Email": "customer_email",
    "Contact Number": "customer_phone",
    "Age": "customer_age",
    "Branch ID": "branch_id",
    "City": "branch_location",
    "Loan Status": "account_status",
    "First Name": "first_name",
    "Last Name": "last_name",
    "Loan Type": "loan_type",
    "Card Type": "card_type",
}

# The canonical staging columns, in order.
CANONICAL_COLUMNS = (
    "customer_id",
    "transaction_id",
    "transaction_date",
    "product_type",
    "transaction_amount",
    "transaction_type",
    "account_type",
    "account_status",
    "customer_name",
    "customer_email",
    "customer_phone",
    "customer_age",
    "customer_segment",
    "branch_id",
    "branch_location",
)

# Strings a pandas CSV reader turns into missing values by default.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Date formats tried in order for a whole column (strptime %Y-%m-%d, %m/%d/%Y, %d/%m/%Y).
DATE_FORMATS = ("yyyy-M-d", "M/d/yyyy", "d/M/yyyy")

# Formats tried on the first value when none of the above fits the whole column.
FALLBACK_DATE_FORMATS = (
    "yyyy-M-d H:m:s", "yyyy-M-d'T'H:m:s", "yyyy-M-d H:m", "M/d/yyyy H:m:s", "M/d/yyyy H:m", "d/M/yyyy H:m:s", "d/M/yyyy H:m",
    "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "d MMMM yyyy", "d-MMM-yyyy", "M-d-yyyy", "yyyy/M/d", "yyyyMMdd", "M/d/yy",
)

# Columns that are stripped and title-cased; a null in any of them drops the row.
TITLE_COLUMNS = ("customer_name", "branch_location", "product_type")

# A row missing any of these is dropped.
CRITICAL_COLUMNS = ("customer_id", "transaction_id", "transaction_date", "transaction_amount")

# Fill values for the remaining nullable attributes.
FILL_DEFAULTS = {
    "account_status": "UNKNOWN",
    "product_type": "UNCLASSIFIED",
    "customer_segment": "GENERAL",
}

# Keep-first duplicate key of a cleaned batch.
DEDUPE_KEYS = ("customer_id", "transaction_id", "transaction_date")

# Quality status order; ERROR and SKIPPED never change the overall status.
STATUS_SEVERITY = {"PASS": 0, "WARNING": 1, "FAIL": 2}

UNKNOWN_KEY = 1
UNKNOWN_DATE = "1900-01-01"
PRODUCT_CATEGORY = "BANKING"
FACT_QUALITY_SCORE = Decimal("0.95")
# --- end of fixed values ---


@dataclass(frozen=True)
class Settings:
    """Everything a run needs besides its inputs."""

    min_completeness_pct: float = 95.0
    max_null_pct: float = 5.0
    duplicate_check_enabled: bool = True
    date_formats: tuple = DATE_FORMATS
    fallback_date_formats: tuple = FALLBACK_DATE_FORMATS
    dedupe_keys: tuple = DEDUPE_KEYS
    critical_columns: tuple = CRITICAL_COLUMNS
    fill_defaults: dict = field(default_factory=lambda: dict(FILL_DEFAULTS))
    # "column": one date format per column and batch; "row": each value by itself.
    date_mode: str = "column"
    # Quoted fields of delivered CSV files may hold line breaks (found out in one pass over the
    # files); set False for files that are known to have none.
    csv_multi_line: bool = True
    pipeline_name: str = "txmart_nightly"
    task_name: str = "full_pipeline"
