"""Dimensions (D-2 .. D-8, D-10): seeds, Type 1 merges from the cleaned layer, calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmart import schemas
from txmart.functions.calendar import calendar_columns
from txmart.operators.merge import _now, insert_if_absent, upsert
from txmart.settings import PRODUCT_CATEGORY, UNKNOWN_DATE, UNKNOWN_KEY

_EPOCH = dt.datetime(1970, 1, 1)


def empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


# --- Fixed values: unknown members (key 1) ---
def seed_customers(spark: SparkSession, now=_EPOCH) -> DataFrame:
    """D-8: the unknown customer."""
    return spark.createDataFrame(
        [(UNKNOWN_KEY, "UNKNOWN", "UNKNOWN", None, None, None, "UNKNOWN", True, now, now)], schemas.DIM_CUSTOMERS
    )


def seed_products(spark: SparkSession, now=_EPOCH) -> DataFrame:
    """D-8: the unknown product."""
    return spark.createDataFrame([(UNKNOWN_KEY, "UNKNOWN", "UNKNOWN", "UNKNOWN", "UNKNOWN", True, now, now)], schemas.DIM_PRODUCTS)


def seed_time(spark: SparkSession) -> DataFrame:
    """D-8: the unknown date 1900-01-01 (a Monday, ISO week 1)."""
    d = dt.date.fromisoformat(UNKNOWN_DATE)
    return spark.createDataFrame([(UNKNOWN_KEY, d, 1900, 1, 1, 1, 1, "Monday", "January", 1, False)], schemas.DIM_TIME)


def seed_branches(spark: SparkSession) -> DataFrame:
    """Branches have no unknown member (an unmatched branch key stays null)."""
    return empty(spark, schemas.DIM_BRANCHES)


# Reference members (D-7): product_id, product_type, product_name, product_category.
REFERENCE_PRODUCTS = [
    ("PROD001", "Savings Account", "Basic Savings Account", "Deposit"),
    ("PROD002", "Checking Account", "Premium Checking Account", "Deposit"),
    ("PROD003", "Credit Card", "Gold Credit Card", "Credit"),
    ("PROD004", "Personal Loan", "Personal Loan Product", "Loan"),
    ("PROD005", "Home Loan", "Mortgage Product", "Loan"),
    ("PROD006", "Investment Account", "Brokerage Account", "Investment"),
    ("PROD007", "Money Market", "Money Market Fund", "Investment"),
    ("PROD008", "Auto Loan", "Vehicle Finance", "Loan"),
]
# branch_id, branch_name, branch_location (city/state/country are not in the table).
REFERENCE_BRANCHES = [
    ("BRN001", "Main Branch", "Downtown"),
    ("BRN002", "Midtown Branch", "Midtown"),
    ("BRN003", "Brooklyn Branch", "Brooklyn"),
    ("BRN004", "Queens Branch", "Flushing"),
    ("BRN005", "Manhattan West", "West Side"),
    ("BRN006", "Bronx Branch", "Grand Concourse"),
]
# --- end of fixed values ---


# ---------------------------------------------------------------- merges from the cleaned layer

def customers_source(cleaned: DataFrame) -> DataFrame:
    """D-2 input: customer attributes of every cleaned row with an id."""
    return cleaned.where(F.col("customer_id").isNotNull()).select(
        "source_row_id", "customer_id", "customer_name", "customer_email", "customer_phone",
        F.col("customer_age").cast("int").alias("customer_age"), "customer_segment",
    )


def merge_customers(dim: DataFrame, cleaned: DataFrame, now=None, on_conflicting: str = "latest") -> DataFrame:
    """D-2: upsert customers; name, email, phone, age and segment are overwritten."""
    attrs = ["customer_name", "customer_email", "customer_phone", "customer_age", "customer_segment"]
    return upsert(
        dim, customers_source(cleaned), "customer_id", "customer_key", attrs,
        {"customer_id": F.col("customer_id"), **{a: F.col(a) for a in attrs}, "is_active": F.lit(True)},
        now=now, on_conflicting=on_conflicting,
    )


def merge_products(dim: DataFrame, cleaned: DataFrame, now=None) -> DataFrame:
    """D-3: id = type = name = product_type, category BANKING; the name is overwritten."""
    src = cleaned.where(F.col("product_type").isNotNull()).select("source_row_id", "product_type")
    return upsert(
        dim, src, "product_type", "product_key", ["product_name"],
        {"product_type": F.col("product_type"), "product_id": F.col("product_type"), "product_name": F.col("product_type"),
         "product_category": F.lit(PRODUCT_CATEGORY), "is_active": F.lit(True)},
        now=now,
    )


def merge_branches(dim: DataFrame, cleaned: DataFrame, now=None) -> DataFrame:
    """D-4: name = branch_id; the location is overwritten."""
    src = cleaned.where(F.col("branch_id").isNotNull()).select("source_row_id", "branch_id", "branch_location")
    return upsert(
        dim, src, "branch_id", "branch_key", ["branch_location"],
        {"branch_id": F.col("branch_id"), "branch_name": F.col("branch_id"), "branch_location": F.col("branch_location"),
         "is_active": F.lit(True)},
        now=now,
    )


def time_rows(dates: DataFrame, date_col: str = "date", dow_style: str = "iso") -> DataFrame:
    """Calendar attributes for a column of dates."""
    d = F.col(date_col)
    return dates.select(d.alias("date"), *[c.alias(n) for n, c in calendar_columns(d, dow_style).items()])


def merge_time(dim: DataFrame, cleaned: DataFrame) -> DataFrame:
    """D-5: one row per distinct transaction date; existing dates are left untouched."""
    dates = cleaned.where(F.col("transaction_date").isNotNull()).select(F.to_date("transaction_date").alias("date")).distinct()
    return insert_if_absent(dim, time_rows(dates), "date", "time_key")


def calendar(spark: SparkSession, start: str = "2024-01-01", end: str = "2024-12-31", dow_style: str = "sunday0") -> DataFrame:
    """D-6: one row per day from ``start`` to ``end``; the sample calendar numbers days
    Sunday=0 with weekend (0, 6)."""
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.expr("INTERVAL 1 DAY"))).alias("date"))
    return time_rows(days, "date", dow_style)


def add_reference_members(spark: SparkSession, products: DataFrame, branches: DataFrame, now=None):
    """D-7: the sample products and branches, inserted if absent (by id)."""
    ts = _now(now)
    p = spark.createDataFrame(REFERENCE_PRODUCTS, "product_id string, product_type string, product_name string, product_category string")
    p = p.withColumn("is_active", F.lit(True))
    b = spark.createDataFrame(REFERENCE_BRANCHES, "branch_id string, branch_name string, branch_location string")
    b = b.withColumn("is_active", F.lit(True))
    return (
        insert_if_absent(products, p, "product_id", "product_key", now=ts),
        insert_if_absent(branches, b, "branch_id", "branch_key", now=ts),
    )


def dimension_counts(**dims: DataFrame) -> DataFrame:
    """D-10: rows per dimension as (dimension, row_count)."""
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("dimension"), "row_count") for name, df in dims.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
