"""Audit tables (S-11, Q-9, Q-10): metric rows and the run log.

Both tables get a handful of rows per run, so their keys are numbered with a plain
``row_number`` over the run's rows (bounded by the number of checks), on top of the
table's current maximum.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txmart import schemas
from txmart.operators.keys import next_key_base


def metric_rows(metrics: DataFrame, existing: DataFrame, batch_id: str, checked_at: dt.datetime) -> DataFrame:
    """S-11: metric rows in the ``audit.data_quality_metrics`` shape, keys after the
    current maximum. ``percentage`` already falls back to ``value``."""
    order = Window.orderBy("table_name", "metric_name")
    base = next_key_base(existing, "quality_key")
    rows = metrics.crossJoin(F.broadcast(base)).select(
        (F.col("_base") + F.row_number().over(order)).cast("long").alias("quality_key"),
        F.lit(batch_id).alias("etl_batch_id"),
        "table_name",
        "metric_name",
        F.col("metric_value").cast("decimal(18,4)").alias("metric_value"),
        F.col("metric_percentage").cast("decimal(7,2)").alias("metric_percentage"),
        "record_count",
        "quality_status",
        "metric_description",
        F.lit(checked_at).cast("timestamp_ntz").alias("checked_at"),
    )
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in schemas.QUALITY_METRICS.fields])


def run_log_row(
    spark: SparkSession,
    existing: DataFrame,
    batch_id: str,
    pipeline: str,
    task: str,
    start: dt.datetime,
    end: dt.datetime,
    quality_passed: bool,
    extracted: int,
    transformed: int,
    loaded: int,
    rejected: int,
    error: str | None = None,
) -> DataFrame:
    """Q-9: one run-log row; status SUCCESS when quality passed else WARNING; duration
    spans the whole job (the source logged its own task's start, so ~0)."""
    status = "SUCCESS" if quality_passed else "WARNING"
    if error:
        status = "FAILED"
    duration = int((end - start).total_seconds())
    row = spark.createDataFrame(
        [(batch_id, pipeline, task, start, end, status, extracted, transformed, loaded, rejected, error, duration, end)],
        "etl_batch_id string, pipeline_name string, task_name string, execution_start timestamp_ntz, "
        "execution_end timestamp_ntz, execution_status string, rows_extracted bigint, rows_transformed bigint, "
        "rows_loaded bigint, rows_rejected bigint, error_message string, execution_duration_seconds bigint, created_at timestamp_ntz",
    )
    row = row.crossJoin(F.broadcast(next_key_base(existing, "execution_id"))).withColumn(
        "execution_id", (F.col("_base") + 1).cast("long")
    )
    return row.select(*[F.col(f.name).cast(f.dataType) for f in schemas.EXECUTION_LOG.fields])


def batch_id_now(now: dt.datetime | None = None) -> str:
    """Run id ``yyyyMMdd_HHmmss_SSS`` (UTC)."""
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return now.strftime("%Y%m%d_%H%M%S_") + f"{now.microsecond // 1000:03d}"
