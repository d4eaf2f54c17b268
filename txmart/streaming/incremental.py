"""Incremental runs (I-1, I-2) with Structured Streaming.

A file stream watches the landing folder; its checkpoint remembers which files were seen.
Each micro-batch only records the paths that landed (no file content is read), and when
``trigger(availableNow=True)`` has taken all that landed, one run of the batch job stages
and transforms every recorded file that is not in the ledger of delivered files. How files
were split into micro-batches therefore cannot change the result: a date format or a
duplicate is decided over all pending rows, as in a batch run. A replayed micro-batch
records paths again, a failed run is made up for by the next one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmart.plans import job
from txmart.settings import Settings
from txmart.sources.files import plain_path
from txmart.sources.warehouse import Warehouse

LANDED = "staging.landed_files"


def landing_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """The paths that land in ``landing_dir`` (file contents are pruned from the scan)."""
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    return reader.option("maxFilesPerTrigger", max_files_per_trigger).load(landing_dir).select(F.col("_metadata.file_path").alias("path"), "length")


def _record(warehouse_root: str, stamp: dt.datetime):
    def handle(batch: DataFrame, epoch_id: int) -> None:
        paths = batch.select("path", F.lit(stamp).cast("timestamp_ntz").alias("landed_at"))
        Warehouse(batch.sparkSession, warehouse_root).append(LANDED, paths)

    return handle


def pending_files(wh: Warehouse) -> list[str]:
    """Landed files that no run has taken, by path (one short row per file)."""
    taken = wh.read(job.FILES).select(F.col("source_file_path").alias("path"))
    return [r["path"] for r in wh.read(LANDED).select("path").distinct().join(taken, "path", "left_anti").orderBy("path").collect()]


def run_available(
    spark: SparkSession,
    landing_dir: str,
    warehouse_root: str,
    checkpoint_dir: str | None = None,
    settings: Settings | None = None,
    fmt: str = "csv",
    now: dt.datetime | None = None,
    max_files_per_trigger: int = 1000,
) -> "job.RunSummary | None":
    """I-1: take every file that has landed and not been taken yet, run the job once, stop.
    Returns the run's summary, or None when nothing was pending."""
    stamp = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    stream = landing_stream(spark, landing_dir, max_files_per_trigger)
    query = (
        stream.writeStream.foreachBatch(_record(warehouse_root, stamp))
        .option("checkpointLocation", checkpoint_dir or f"{warehouse_root.rstrip('/')}/_stream_checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    paths = [plain_path(p) for p in pending_files(Warehouse(spark, warehouse_root))]
    return job.run(spark, paths, warehouse_root, settings, now=stamp, fmt=fmt) if paths else None
