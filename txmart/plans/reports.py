"""Analytic reports over the mart (A-1 .. A-7) as DataFrame plans.

Every report takes the mart tables as DataFrames and returns a DataFrame; nothing is
collected. Time windows take an explicit ``as_of`` (a timestamp literal or Column);
``None`` means ``current_timestamp()``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txmart.functions.values import duration_text, rate_pct
from txmart.operators import bitmaps


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp_ntz")


def customer_summary(dim_customers: DataFrame, fact: DataFrame, top: int = 20) -> DataFrame:
    """A-1: per active customer — distinct transactions, total, average, last date.

    The fact is aggregated per ``customer_key`` first (one row per customer leaves the
    fact side), then left-joined to the customers, so the big side is never shuffled for
    the join. Customers without transactions stay and sort first: SQL ``DESC`` puts NULLs
    first in the source system, so the order is ``total_amount DESC NULLS FIRST``, ties
    broken by ``customer_key``. ``top`` rows are the report (a top-k), not a cap.
    """
    c = dim_customers.where(F.col("is_active")).select("customer_key", "customer_name", "customer_segment")
    per_customer = fact.groupBy("customer_key").agg(
        F.count_distinct("transaction_id").alias("transaction_count"),
        F.sum("transaction_amount").alias("total_amount"),
        F.avg("transaction_amount").alias("avg_amount"),
        F.max("transaction_date").alias("last_transaction"),
    )
    out = (
        c.join(per_customer, "customer_key", "left")
        .select(
            "customer_key", "customer_name", "customer_segment",
            F.coalesce(F.col("transaction_count"), F.lit(0)).alias("transaction_count"),
            "total_amount", "avg_amount", "last_transaction",
        )
        .orderBy(F.col("total_amount").desc_nulls_first(), F.col("customer_key"))
    )
    return out.limit(top) if top else out


def product_performance(dim_products: DataFrame, fact: DataFrame) -> DataFrame:
    """A-2: per active product — transactions, volume, average, customers and penetration.

    Facts are added up per product and customer, then per product, with no row copied for a
    second distinct count: a transaction has one customer, as the fact's unique
    ``transaction_id`` says, so distinct transactions add up over customers. The denominator of
    the penetration is one set of all customers (a bitmap per 32,768 keys) built in a scan of
    ``customer_key`` alone, of which a map task shuffles a few rows.
    """
    p = dim_products.where(F.col("is_active")).select("product_key", "product_type", "product_name")
    pairs = fact.groupBy("product_key", "customer_key").agg(
        F.count_distinct("transaction_id").alias("transactions"),
        F.sum("transaction_amount").alias("volume"),
        F.count("transaction_amount").alias("amounts"),
    )
    per_product = pairs.groupBy("product_key").agg(
        F.sum("transactions").alias("transaction_count"),
        F.sum("volume").alias("total_volume"),
        (F.sum("volume") / F.sum("amounts")).alias("avg_transaction"),
        F.count("customer_key").alias("customer_count"),
    )
    all_customers = bitmaps.cardinality(bitmaps.key_sets(fact, {}, "customer_key"), [], "_all_customers")
    return (
        p.join(per_product, "product_key", "left")
        .crossJoin(F.broadcast(all_customers))
        .select(
            "product_key", "product_type", "product_name",
            F.coalesce(F.col("transaction_count"), F.lit(0)).alias("transaction_count"),
            "total_volume", "avg_transaction",
            F.coalesce(F.col("customer_count"), F.lit(0)).alias("customer_count"),
            F.round(
                (F.coalesce(F.col("customer_count"), F.lit(0)) * 100).cast("decimal(38,0)") / F.nullif(F.col("_all_customers"), F.lit(0)), 2
            ).alias("customer_penetration_pct"),
        )
        .orderBy(F.col("total_volume").desc_nulls_first(), F.col("product_key"))
    )


def monthly_trend(fact: DataFrame) -> DataFrame:
    """A-3: per calendar month — transactions, volume, average, active customers.

    Customers are counted in bitmaps, one per month and 32,768 keys, so that only the
    transaction ids are shuffled one by one."""
    month = F.trunc("transaction_date", "month")
    sums = fact.groupBy(month.alias("month")).agg(
        F.count_distinct("transaction_id").alias("transactions"),
        F.sum("transaction_amount").alias("volume"),
        F.avg("transaction_amount").alias("avg_transaction"),
    )
    active = bitmaps.cardinality(bitmaps.key_sets(fact, {"_month": month}, "customer_key"), ["_month"], "active_customers")
    return (
        sums.join(active, F.col("month").eqNullSafe(F.col("_month")), "left")
        .select("month", "transactions", "volume", "avg_transaction", F.coalesce("active_customers", F.lit(0).cast("long")).alias("active_customers"))
        .orderBy(F.col("month").desc_nulls_first())
    )


def quality_trend(metrics: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """A-4: quality metrics per day and status over the last ``days`` days."""
    since = _as_of(as_of) - F.make_interval(days=F.lit(days))
    return (
        metrics.where(F.col("checked_at") >= since)
        .groupBy(F.to_date("checked_at").alias("check_date"), "quality_status")
        .agg(
            F.count("*").alias("metric_count"),
            F.round(F.avg("metric_percentage"), 2).alias("avg_quality_pct"),
        )
        .orderBy(F.col("check_date").desc_nulls_first(), F.col("quality_status"))
    )


def run_performance(run_log: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """A-5: runs per day — durations, success count and rate, row totals."""
    since = _as_of(as_of) - F.make_interval(days=F.lit(days))
    ok = F.col("execution_status") == "SUCCESS"
    return (
        run_log.where(F.col("execution_start") >= since)
        .groupBy(F.to_date("execution_start").alias("run_date"))
        .agg(
            F.avg("execution_duration_seconds").alias("avg_duration_sec"),
            F.max("execution_duration_seconds").alias("max_duration_sec"),
            F.count("*").alias("total_runs"),
            F.count_if(ok).alias("successful_runs"),
            F.round((F.count_if(ok) * 100).cast("decimal(38,0)") / F.count("*"), 2).alias("success_rate_pct"),
            F.sum("rows_extracted").alias("total_extracted"),
            F.sum("rows_loaded").alias("total_loaded"),
            F.sum("rows_rejected").alias("total_rejected"),
        )
        .orderBy(F.col("run_date").desc_nulls_first())
    )


def recent_metrics(metrics: DataFrame, as_of=None, days: int = 7) -> DataFrame:
    """A-6: metric rows of the last ``days`` days, newest first."""
    since = _as_of(as_of) - F.make_interval(days=F.lit(days))
    return (
        metrics.where(F.col("checked_at") >= since)
        .select(
            "quality_key", "etl_batch_id", "table_name", "metric_name", "metric_value",
            "metric_percentage", "record_count", "quality_status", "checked_at",
        )
        .orderBy(F.col("checked_at").desc_nulls_first(), F.col("quality_key"))
    )


def latest_batch_report(metrics: DataFrame) -> DataFrame:
    """A-7: metrics of the latest batch (``etl_batch_id = max(etl_batch_id)``).

    The max is a one-row aggregate; the filter is a left-semi join on it, which Spark
    broadcasts (one row).
    """
    latest = metrics.agg(F.max("etl_batch_id").alias("etl_batch_id"))
    return (
        metrics.join(F.broadcast(latest), "etl_batch_id", "left_semi")
        .select("quality_key", "etl_batch_id", "table_name", "metric_name", "metric_percentage", "quality_status")
        .orderBy("table_name", "metric_name", "quality_key")
    )


def run_rates(run_log: DataFrame) -> DataFrame:
    """Q-10 over the run log: success and failure rate per run."""
    total = F.col("rows_extracted")
    processed = F.col("rows_loaded")
    failed = F.col("rows_rejected")
    return run_log.select(
        "execution_id",
        "etl_batch_id",
        total.alias("total"),
        processed.alias("processed"),
        failed.alias("failed"),
        rate_pct(processed, total).alias("success_rate"),
        rate_pct(failed, total).alias("failure_rate"),
        duration_text("execution_duration_seconds").alias("duration_text"),
    )
