"""Reading the given Parquet tables and mart-shaped views over them.

The views rename and retype driver tables into the shapes the mart operators expect
(fact, customer/product dimensions, quality metrics, run log); they are projections
only, so the work of every report grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmart.schemas import MONEY


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_as_fact(orders: DataFrame) -> DataFrame:
    """Orders as transactions: one fact per order."""
    return orders.select(
        F.col("o_custkey").alias("customer_key"),
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_totalprice").cast(MONEY).alias("transaction_amount"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
    )


def customers_as_dim(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("customer_key"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.lit(True).alias("is_active"),
    )


def parts_as_dim(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("product_key"),
        F.col("p_type").alias("product_type"),
        F.col("p_name").alias("product_name"),
        F.lit(True).alias("is_active"),
    )


def lineitems_as_fact(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Line items as transactions of a product by the ordering customer."""
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_key"))
    return lineitem.join(o, "l_orderkey").select(
        F.col("l_partkey").alias("product_key"),
        "customer_key",
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.col("l_extendedprice").cast(MONEY).alias("transaction_amount"),
        F.col("l_shipdate").cast("date").alias("transaction_date"),
    )


# --- Fixed values: event type -> audit status used by the audit stand-in views ---
QUALITY_STATUS_OF_EVENT = {"error": "FAIL", "signup": "WARNING"}  # others PASS
RUN_STATUS_OF_EVENT = {"error": "FAILED", "signup": "WARNING"}  # others SUCCESS
# --- end of fixed values ---


def _status(event_type, mapping: dict, default: str):
    expr = None
    for k, v in mapping.items():
        expr = (F.when(event_type == k, v) if expr is None else expr.when(event_type == k, v))
    return expr.otherwise(default)


def events_as_quality_metrics(events: DataFrame) -> DataFrame:
    """Events as ``audit.data_quality_metrics`` rows: one hourly batch per event hour."""
    et = F.col("event_type")
    return events.select(
        F.col("event_id").alias("quality_key"),
        F.date_format("ts", "yyyyMMdd_HH").alias("etl_batch_id"),
        F.concat(F.lit("table_"), (F.col("user_id") % 3).cast("string")).alias("table_name"),
        F.upper(et).alias("metric_name"),
        F.col("value").cast("decimal(18,4)").alias("metric_value"),
        F.col("value").cast("decimal(7,2)").alias("metric_percentage"),
        F.col("user_id").alias("record_count"),
        _status(et, QUALITY_STATUS_OF_EVENT, "PASS").alias("quality_status"),
        F.col("ts").alias("checked_at"),
    )


def events_as_run_log(events: DataFrame) -> DataFrame:
    """Events as ``audit.etl_execution_log`` rows: one run per event."""
    et = F.col("event_type")
    return events.select(
        F.col("event_id").alias("execution_id"),
        F.col("event_id").cast("string").alias("etl_batch_id"),
        F.col("ts").alias("execution_start"),
        _status(et, RUN_STATUS_OF_EVENT, "SUCCESS").alias("execution_status"),
        (F.col("user_id") * 100).alias("rows_extracted"),
        (F.col("user_id") * 90).alias("rows_loaded"),
        (F.col("user_id") * 10).alias("rows_rejected"),
        F.floor(F.col("value") * 10).cast("long").alias("execution_duration_seconds"),
    )
