"""Fact load (D-9, J-1, J-2) and the loaded/processed flags (S-9, S-10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txmart.operators.clean import keep_first
from txmart.operators.keys import assign_keys, next_key_base
from txmart.operators.merge import _now
from txmart.schemas import FACT, MONEY
from txmart.settings import FACT_QUALITY_SCORE, UNKNOWN_KEY


def not_loaded(cleaned: DataFrame) -> DataFrame:
    if "is_loaded" in cleaned.columns:
        return cleaned.where(~F.coalesce(F.col("is_loaded"), F.lit(False)))
    return cleaned


def resolve_keys(
    cleaned: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    time: DataFrame,
    branches: DataFrame,
) -> DataFrame:
    """J-1/J-2: left joins to the four dimensions on natural keys; unknown customer,
    product and date become key 1, an unknown branch stays null.

    Only (natural key, surrogate key) pairs are joined. No hint: Spark broadcasts a side
    that its byte threshold (measured at run time by AQE) proves small, else it shuffles.
    """
    def side(dim: DataFrame, nat: str, key: str, alias: str) -> DataFrame:
        return dim.select(F.col(nat).alias(alias), F.col(key))

    s = cleaned.withColumn("_date", F.to_date("transaction_date"))
    s = s.join(side(customers, "customer_id", "customer_key", "_c"), s["customer_id"] == F.col("_c"), "left")
    s = s.join(side(products, "product_type", "product_key", "_p"), s["product_type"] == F.col("_p"), "left")
    s = s.join(side(time, "date", "time_key", "_d"), s["_date"] == F.col("_d"), "left")
    s = s.join(side(branches, "branch_id", "branch_key", "_b"), s["branch_id"] == F.col("_b"), "left")
    return s.withColumns(
        {
            "customer_key": F.coalesce(F.col("customer_key"), F.lit(UNKNOWN_KEY)),
            "product_key": F.coalesce(F.col("product_key"), F.lit(UNKNOWN_KEY)),
            "time_key": F.coalesce(F.col("time_key"), F.lit(UNKNOWN_KEY)),
        }
    ).drop("_c", "_p", "_d", "_b")


def fact_rows(resolved: DataFrame, batch_id, now=None) -> DataFrame:
    """D-9 projection: fact columns from resolved cleaned rows (no surrogate key yet)."""
    ts = _now(now)
    bid = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    return resolved.select(
        "source_row_id",
        F.col("customer_key").cast("int").alias("customer_key"),
        F.col("product_key").cast("int").alias("product_key"),
        F.col("time_key").cast("int").alias("time_key"),
        F.col("branch_key").cast("int").alias("branch_key"),
        "transaction_id",
        F.col("customer_id").alias("account_id"),
        F.col("transaction_amount").cast(MONEY).alias("transaction_amount"),
        "transaction_type",
        "account_type",
        "account_status",
        F.col("_date").alias("transaction_date"),
        ts.alias("transaction_timestamp"),
        F.lit(False).alias("is_duplicate"),
        F.lit(FACT_QUALITY_SCORE).cast("decimal(5,2)").alias("data_quality_score"),
        F.lit(None).cast("string").alias("source_system"),
        bid.cast("string").alias("etl_batch_id"),
        ts.alias("created_at"),
        ts.alias("updated_at"),
    )


def new_facts(
    cleaned: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    time: DataFrame,
    branches: DataFrame,
    existing: DataFrame,
    batch_id,
    now=None,
    known: DataFrame | None = None,
    buckets: int | None = None,
    base: DataFrame | None = None,
) -> DataFrame:
    """D-9: the fact rows one load appends.

    Not-yet-loaded cleaned rows -> dimension keys -> first row per ``transaction_id`` by
    ``source_row_id`` (the source database leaves this order unspecified; ours is fixed)
    -> rows whose ``transaction_id`` is already in the fact are dropped (``ON CONFLICT DO
    NOTHING``) -> ``transaction_key`` continues from the fact's maximum.

    ``known`` (the fact's ids clustered into ``buckets`` buckets, ``sources.ledger``) and ``base``
    (one row ``_base``, the greatest key) spare the scans of ``existing``.
    """
    resolved = resolve_keys(not_loaded(cleaned), customers, products, time, branches)
    rows = keep_first(fact_rows(resolved, batch_id, now), ["transaction_id"], "source_row_id")
    rows = absent(rows, existing.select("transaction_id") if known is None else known, buckets).drop("source_row_id")
    keyed = assign_keys(rows, "transaction_key", ["transaction_id"], base=next_key_base(existing, "transaction_key") if base is None else base)
    return keyed.select(*[F.col(f.name).cast(f.dataType) for f in FACT.fields])


def absent(rows: DataFrame, known: DataFrame, buckets: int | None = None) -> DataFrame:
    """J-5: the rows whose ``transaction_id`` is not in ``known``. With ``buckets``, ``known`` is
    clustered so, and only ``rows`` (one per id by now, so no key is hot) are shuffled."""
    if buckets:
        rows = rows.repartition(buckets, "transaction_id")
    return rows.join(known, "transaction_id", "left_anti")


def mark_loaded(cleaned: DataFrame, fact: DataFrame, now=None) -> DataFrame:
    """S-10: not-yet-loaded cleaned rows whose ``transaction_id`` is now in the fact are
    flagged loaded (rows that lost the conflict too). A left join on the fact's distinct
    ids — the ids stay distributed."""
    ts = _now(now)
    ids = fact.select(F.col("transaction_id").alias("_tid")).distinct().withColumn("_hit", F.lit(True))
    j = cleaned.join(ids, cleaned["transaction_id"] == F.col("_tid"), "left")
    flip = ~F.coalesce(F.col("is_loaded"), F.lit(False)) & F.coalesce(F.col("_hit"), F.lit(False))
    return j.withColumns(
        {"is_loaded": F.coalesce(F.col("is_loaded"), F.lit(False)) | flip, "loaded_at": F.when(flip, ts).otherwise(F.col("loaded_at"))}
    ).select(*cleaned.columns)


def take_unprocessed(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S-7: all unprocessed staging rows. Returns ``(batch, cutoff)``; ``cutoff`` is one row
    ``_cut``, the greatest id taken, so S-9 can flag exactly this batch with a projection
    instead of a join."""
    pending = raw.where(~F.coalesce(F.col("is_processed"), F.lit(False)))
    return pending, pending.agg(F.max("id").alias("_cut"))


def mark_processed(raw: DataFrame, cutoff: DataFrame, now=None) -> DataFrame:
    """S-9: every unprocessed row with ``id <= cutoff`` (kept or rejected) is flagged
    processed with ``processed_at = now``; a projection against a one-row cutoff."""
    ts = _now(now)
    j = raw.crossJoin(F.broadcast(cutoff))
    flip = ~F.coalesce(F.col("is_processed"), F.lit(False)) & (F.col("id") <= F.col("_cut"))
    flip = F.coalesce(flip, F.lit(False))
    return j.withColumns(
        {"is_processed": F.coalesce(F.col("is_processed"), F.lit(False)) | flip, "processed_at": F.when(flip, ts).otherwise(F.col("processed_at"))}
    ).select(*raw.columns)


# ---------------------------------------------------------------- watermark form of S-7/S-9/S-10

def watermark(marks: DataFrame, col: str) -> int:
    """The greatest ``col`` over the run marks (-1 when none): one scalar."""
    v = marks.agg(F.max(col)).first()[0]
    return -1 if v is None else int(v)


def with_run_flags(df: DataFrame, marks: DataFrame, id_col: str, through_col: str, flag: str, at: str) -> DataFrame:
    """The reference-shaped flag columns of an append-only table, derived from the run
    marks: ``flag`` = id <= the latest watermark; ``at`` = the time of the first run whose
    watermark covers the id.

    The watermarks (one per run, a bounded list) become the splits of a ``Bucketizer``,
    which finds each row's run by binary search; the run times join back by broadcast on
    the bucket number. No row is compared against every run.
    """
    firsts = (
        marks.where(F.col(through_col).isNotNull())
        .groupBy(F.col(through_col).alias("_hi"))
        .agg(F.min("marked_at").alias("_at"))
        .orderBy("_hi")
        .collect()  # one row per distinct watermark (bounded by the number of runs)
    )
    out = df.drop(flag, at)
    if not firsts:
        return out.withColumn(flag, F.lit(False)).withColumn(at, F.lit(None).cast("timestamp_ntz")).select(*df.columns)
    from pyspark.ml.feature import Bucketizer

    splits = [float("-inf")] + [float(r["_hi"]) + 0.5 for r in firsts] + [float("inf")]
    times = df.sparkSession.createDataFrame(
        [(float(i), r["_at"]) for i, r in enumerate(firsts)], "_bucket double, _at timestamp_ntz"
    )
    bucketed = Bucketizer(splits=splits, inputCol="_idd", outputCol="_bucket").transform(
        out.withColumn("_idd", F.col(id_col).cast("double"))
    )
    j = bucketed.join(F.broadcast(times), "_bucket", "left")
    return (
        j.withColumn(flag, F.col(id_col) <= F.lit(int(firsts[-1]["_hi"])))
        .withColumn(at, F.col("_at"))
        .select(*df.columns)
    )
