"""Surrogate keys (K-1): SERIAL-style dense numbers without a single-partition window.

``assign_keys`` numbers rows ``base + 1, base + 2, ...`` in the order of ``order_cols``
(which should be unique, e.g. a natural key). It equals
``base + row_number() OVER (ORDER BY order_cols)`` but runs distributed:

1. range-partition by ``order_cols`` (sampled bounds, balanced for distinct keys) and
   sort within partitions;
2. stamp each row with its partition id and its position in the partition
   (``monotonically_increasing_id`` minus the partition's id offset);
3. ``checkpoint()`` to the shared checkpoint folder, so the sampled bounds and
   positions are fixed once and survive executor loss;
4. count rows per partition (one row per partition), cumulative offsets over those
   counts, and join the offsets back by broadcast — its size is bounded by the
   partition count, not by the data.

``number_by_place`` numbers scanned rows without moving them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txmart.session import ensure_checkpoint_dir


def next_key_base(existing: DataFrame, key_col: str, floor: int = 0) -> DataFrame:
    """One row ``_base``: ``greatest(coalesce(max(key), floor), floor)`` (G-9). New keys
    start at ``_base + 1``: 2 above a seeded unknown member, 1 in an empty table."""
    return existing.agg(F.greatest(F.coalesce(F.max(key_col), F.lit(floor)), F.lit(floor)).cast("long").alias("_base"))


def number_by_place(df: DataFrame, key_col: str, places: DataFrame, base: DataFrame) -> DataFrame:
    """Add ``key_col`` = base + place of the row in the order of file, piece and position, and
    what else ``places`` says of its piece.

    For rows that carry where they were scanned (``_source_file_path, _block, _pos``, dense from
    ``first`` within a piece): ``places`` has one row per piece with its number of ``records``,
    a running sum over these few rows gives every piece its first number, and a row's number
    is a projection. Nothing is shuffled or checkpointed. ``places`` is broadcast: a scan has as
    many pieces as the driver plans tasks for."""
    upto = Window.orderBy("_source_file_path", "_block").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("records").over(upto), F.lit(0)) - F.col("first")
    offsets = places.withColumn("_shift", shift).drop("records", "first").crossJoin(F.broadcast(base.select(F.col("_base").cast("long"))))
    key = F.col("_base") + F.col("_shift") + F.col("_pos") + 1
    return df.join(F.broadcast(offsets), ["_source_file_path", "_block"]).withColumn(key_col, key).drop("_shift", "_base")


def assign_keys(
    df: DataFrame,
    key_col: str,
    order_cols,
    base: int | DataFrame = 0,
    num_partitions: int | None = None,
    key_type: str = "long",
) -> DataFrame:
    """Add ``key_col`` = base + dense rank of the row in ``order_cols`` order (1-based)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    order = [F.col(c) if isinstance(c, str) else c for c in ([order_cols] if isinstance(order_cols, (str, Column)) else order_cols)]
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    pid = F.spark_partition_id().cast("long")
    ranged = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_kp", pid)
        .withColumn("_ki", F.monotonically_increasing_id() - F.shiftleft(pid, 33))
        .checkpoint(eager=True)
    )
    counts = ranged.groupBy("_kp").agg(F.count("*").alias("_kn"))
    before = Window.orderBy("_kp").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_kp", F.coalesce(F.sum("_kn").over(before), F.lit(0)).alias("_koff"))
    if isinstance(base, DataFrame):
        offsets = offsets.crossJoin(F.broadcast(base.select(F.col("_base").cast("long"))))
    else:
        offsets = offsets.withColumn("_base", F.lit(int(base)).cast("long"))
    key = (F.col("_base") + F.col("_koff") + F.col("_ki") + 1).cast(key_type)
    return (
        ranged.join(F.broadcast(offsets), "_kp")
        .withColumn(key_col, key)
        .drop("_kp", "_ki", "_koff", "_base")
    )
