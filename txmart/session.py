"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of DataFrames that are gone are deleted by the context cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", app: str = "txmart", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (cluster jobs bring their own)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**LOCAL_CONF, "spark.driver.memory": "16g", **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    The folder the cluster names in ``spark.checkpoint.dir``, else one already set on the
    context. Where neither is set, a local session falls back to a folder under its SQL
    warehouse; on a cluster that folder could be local to one machine, so this raises.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_checkpoints")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


_scratch: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root, deleted when the driver
    program ends (a driver that is killed leaves it to the cluster's cleaning of that root)."""
    path = f"{checkpoint_root(spark)}/txmart-{name}-{uuid.uuid4().hex[:12]}"
    _scratch.append((spark, path))
    return path


@atexit.register
def _delete_scratch() -> None:
    for spark, path in _scratch:
        with contextlib.suppress(Exception):  # the session may be gone by now
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    checkpoint_root(spark)


def cluster_conf(input_bytes: int, executor_cores: int = 4, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings sized for a batch of ``input_bytes`` on a cluster: scan splits and the
    initial shuffle partition count from the input size (AQE then coalesces small
    partitions and splits skewed join partitions at run time)."""
    parts = max(200, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.executor.cores": str(executor_cores),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # runtime Bloom filters from the small side of a shuffled join (e.g. the batch's
        # transaction ids) pre-filter the big side's scan before its shuffle
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    }

