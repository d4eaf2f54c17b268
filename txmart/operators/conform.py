"""Conforming a delivered file to the 15 canonical staging columns (P-1 .. P-6, S-2).

All steps are projections: no shuffle, and Catalyst prunes any source column that is
not used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txmart.functions.text import null_if_na, trim_ws
from txmart.settings import CANONICAL_COLUMNS, NA_TOKENS, SOURCE_COLUMN_MAP


def _q(name: str) -> str:
    return f"`{name}`"


def trim_headers(df: DataFrame) -> DataFrame:
    """P-1a: strip blanks around header names (CSV keeps them)."""
    return df.toDF(*[c.strip() for c in df.columns])


def rename_columns(df: DataFrame, mapping: dict | None = None) -> DataFrame:
    """P-1b: rename human headers to canonical names; unknown headers are kept."""
    mapping = SOURCE_COLUMN_MAP if mapping is None else mapping
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def na_to_null(df: DataFrame, tokens=NA_TOKENS, columns=None) -> DataFrame:
    """S-2: the NA strings a pandas reader would turn into missing values become null."""
    cols = [c for c in (columns or df.columns) if dict(df.dtypes)[c] == "string"]
    return df.withColumns({c: null_if_na(F.col(_q(c)), tokens) for c in cols}) if cols else df


def customer_name(df: DataFrame) -> DataFrame:
    """P-2: ``strip(strip(first) + ' ' + strip(last))`` with nulls as ''; null if either
    name column is absent. The result may be '' (not null)."""
    if {"first_name", "last_name"} <= set(df.columns):
        name = trim_ws(
            F.concat(trim_ws(F.coalesce(F.col("first_name"), F.lit(""))), F.lit(" "), trim_ws(F.coalesce(F.col("last_name"), F.lit(""))))
        )
    else:
        name = F.lit(None).cast("string")
    return df.withColumn("customer_name", name)


def product_and_defaults(df: DataFrame) -> DataFrame:
    """P-3/P-4: ``product_type`` from account → loan → card type → 'UNCLASSIFIED' when the
    file has no product column; absent status/segment columns get constants."""
    out = df
    if "product_type" not in df.columns:
        parts = [F.col(c) for c in ("account_type", "loan_type", "card_type") if c in df.columns]
        out = out.withColumn("product_type", F.coalesce(*parts, F.lit("UNCLASSIFIED")))
    if "account_status" not in df.columns:
        out = out.withColumn("account_status", F.lit("UNKNOWN"))
    if "customer_segment" not in df.columns:
        out = out.withColumn("customer_segment", F.lit("GENERAL"))
    return out


def project_canonical(df: DataFrame, extra=()) -> DataFrame:
    """P-5: the 15 canonical columns in order, absent ones as null strings."""
    cols = [
        (F.col(_q(c)).cast("string") if c in df.columns else F.lit(None).cast("string")).alias(c) for c in CANONICAL_COLUMNS
    ]
    return df.select(*[F.col(_q(e)) for e in extra], *cols)


def drop_empty_rows(df: DataFrame, extra=()) -> DataFrame:
    """P-6: drop rows whose canonical columns are all null."""
    return df.na.drop(how="all", subset=list(CANONICAL_COLUMNS))


def conform(df: DataFrame, na_tokens=NA_TOKENS, extra=(), drop_empty_before_defaults: bool = False) -> DataFrame:
    """P-1..P-6 in the source order: trim and rename headers, NA tokens to null, build the
    name, fill product/status/segment when absent, project, drop all-null rows.

    With the default order (as delivered) the all-null drop runs after the defaults, so it
    never fires; ``drop_empty_before_defaults=True`` gives the useful form.
    """
    out = rename_columns(trim_headers(df))
    if na_tokens:
        out = na_to_null(out, na_tokens, [c for c in out.columns if c not in extra])
    out = customer_name(out)
    if drop_empty_before_defaults:
        present = [F.col(_q(c)) for c in CANONICAL_COLUMNS if c in out.columns]
        out = out.where(F.coalesce(*present).isNotNull() if present else F.lit(False))
    out = product_and_defaults(out)
    return drop_empty_rows(project_canonical(out, extra))
