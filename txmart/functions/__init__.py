"""Column expressions (JVM-side, no Python UDFs)."""

from txmart.functions.text import title_case, trim_ws, null_if_na
from txmart.functions.values import (
    age_to_int,
    amount_value,
    batch_id_of,
    duration_text,
    rate_pct,
)
from txmart.functions.calendar import calendar_columns, parse_with_formats

__all__ = [
    "title_case",
    "trim_ws",
    "null_if_na",
    "age_to_int",
    "amount_value",
    "batch_id_of",
    "duration_text",
    "rate_pct",
    "calendar_columns",
    "parse_with_formats",
]
