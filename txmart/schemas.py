"""Explicit schemas of every mart table."""

from __future__ import annotations

from pyspark.sql import types as T

from txmart.settings import CANONICAL_COLUMNS

S, L, I, B = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()
TS, D = T.TimestampNTZType(), T.DateType()
MONEY = T.DecimalType(18, 2)


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


CANONICAL = _struct(*[(c, S, True) for c in CANONICAL_COLUMNS])

RAW = _struct(
    ("id", L, False),
    *[(c, S, True) for c in CANONICAL_COLUMNS],
    ("source_file_name", S, True),
    ("source_file_hash", S, True),
    ("raw_data", S, True),
    ("is_processed", B, False),
    ("processed_at", TS, True),
    ("created_at", TS, False),
)

CLEANED = _struct(
    ("source_row_id", L, False),
    ("customer_id", S, True),
    ("transaction_id", S, True),
    ("transaction_date", TS, True),
    ("product_type", S, True),
    ("transaction_amount", MONEY, True),
    ("transaction_type", S, True),
    ("account_type", S, True),
    ("account_status", S, True),
    ("customer_name", S, True),
    ("customer_email", S, True),
    ("customer_phone", S, True),
    ("customer_age", I, True),
    ("customer_segment", S, True),
    ("branch_id", S, True),
    ("branch_location", S, True),
    ("is_loaded", B, False),
    ("loaded_at", TS, True),
    ("created_at", TS, False),
)

DIM_CUSTOMERS = _struct(
    ("customer_key", I, False),
    ("customer_id", S, False),
    ("customer_name", S, True),
    ("customer_email", S, True),
    ("customer_phone", S, True),
    ("customer_age", I, True),
    ("customer_segment", S, True),
    ("is_active", B, False),
    ("created_at", TS, False),
    ("updated_at", TS, False),
)

DIM_PRODUCTS = _struct(
    ("product_key", I, False),
    ("product_id", S, False),
    ("product_type", S, False),
    ("product_name", S, False),
    ("product_category", S, True),
    ("is_active", B, False),
    ("created_at", TS, False),
    ("updated_at", TS, False),
)

DIM_BRANCHES = _struct(
    ("branch_key", I, False),
    ("branch_id", S, False),
    ("branch_name", S, True),
    ("branch_location", S, True),
    ("is_active", B, False),
    ("created_at", TS, False),
    ("updated_at", TS, False),
)

DIM_TIME = _struct(
    ("time_key", I, False),
    ("date", D, False),
    ("year", I, False),
    ("quarter", I, False),
    ("month", I, False),
    ("day", I, False),
    ("day_of_week", I, False),
    ("day_name", S, False),
    ("month_name", S, False),
    ("week_of_year", I, False),
    ("is_weekend", B, False),
)

FACT = _struct(
    ("transaction_key", L, False),
    ("customer_key", I, False),
    ("product_key", I, False),
    ("time_key", I, False),
    ("branch_key", I, True),
    ("transaction_id", S, False),
    ("account_id", S, True),
    ("transaction_amount", MONEY, False),
    ("transaction_type", S, True),
    ("account_type", S, True),
    ("account_status", S, True),
    ("transaction_date", D, False),
    ("transaction_timestamp", TS, False),
    ("is_duplicate", B, False),
    ("data_quality_score", T.DecimalType(5, 2), True),
    ("source_system", S, True),
    ("etl_batch_id", S, True),
    ("created_at", TS, False),
    ("updated_at", TS, False),
)

QUALITY_METRICS = _struct(
    ("quality_key", L, False),
    ("etl_batch_id", S, False),
    ("table_name", S, False),
    ("metric_name", S, False),
    ("metric_value", T.DecimalType(18, 4), True),
    ("metric_percentage", T.DecimalType(7, 2), True),
    ("record_count", L, True),
    ("quality_status", S, True),
    ("metric_description", S, True),
    ("checked_at", TS, False),
)

EXECUTION_LOG = _struct(
    ("execution_id", L, False),
    ("etl_batch_id", S, False),
    ("pipeline_name", S, False),
    ("task_name", S, True),
    ("execution_start", TS, False),
    ("execution_end", TS, True),
    ("execution_status", S, True),
    ("rows_extracted", L, False),
    ("rows_transformed", L, False),
    ("rows_loaded", L, False),
    ("rows_rejected", L, False),
    ("error_message", S, True),
    ("execution_duration_seconds", L, True),
    ("created_at", TS, False),
)

# One row per run: ids up to ``processed_through`` are processed, cleaned rows up to
# ``loaded_through`` are loaded (S-9/S-10 as watermarks; the big tables are never rewritten).
RUN_MARKS = _struct(
    ("etl_batch_id", S, False),
    ("processed_through", L, True),
    ("loaded_through", L, True),
    ("marked_at", TS, False),
)

# One row per staged file: what the re-delivery guard (I-2) checks, instead of the raw history.
DELIVERED_FILES = _struct(
    ("source_file_hash", S, True),
    ("source_file_name", S, True),
    ("source_file_path", S, True),
    ("rows_staged", L, False),
    ("etl_batch_id", S, False),
    ("staged_at", TS, False),
    ("error", S, True),  # why a file that was read gave no rows
)

# What the file stream has seen land (one row per file and micro-batch; replays repeat rows).
LANDED_FILES = _struct(("path", S, False), ("landed_at", TS, False))

# What the nightly checks know of a part of an append-only table (see operators.states).
PART_STATES = _struct(
    ("table_name", S, False),
    ("part", S, False),
    ("row_count", L, False),
    ("null_counts", T.MapType(S, L), False),
    ("max_key", L, True),
)

# Table name -> schema, in the layers they live in.
TABLES = {
    "staging.raw_banking_data": RAW,
    "staging.cleaned_banking_data": CLEANED,
    "staging.run_marks": RUN_MARKS,
    "staging.delivered_files": DELIVERED_FILES,
    "staging.landed_files": LANDED_FILES,
    "mart.dim_customers": DIM_CUSTOMERS,
    "mart.dim_products": DIM_PRODUCTS,
    "mart.dim_branches": DIM_BRANCHES,
    "mart.dim_time": DIM_TIME,
    "mart.fact_transactions": FACT,
    "audit.data_quality_metrics": QUALITY_METRICS,
    "audit.etl_execution_log": EXECUTION_LOG,
    "audit.part_states": PART_STATES,
}
