"""Registered end-to-end queries: the file-driven job (R-1) and the incremental stream (I-1).

Both land F_RAW as CSV part files in two deliveries (order dates before 1998, then the
rest) under a fresh folder in the shared checkpoint root, run the job / the stream once
per delivery, and return the final fact table. Their oracle is the two-load mart in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from txmart.plans import fixtures as fx
from txmart.plans import job
from txmart.plans.oracle_sql import two_loads_sql
from txmart.plans.q_mart import NOW1, NOW2
from txmart.plans.registry import register
from txmart.session import scratch_path
from txmart.streaming import incremental

FACT_OUT = [
    "transaction_key", "customer_key", "product_key", "time_key", "branch_key", "transaction_id", "account_id",
    "transaction_amount", "transaction_type", "account_type", "account_status", "transaction_date",
]
ORACLE = (f"with {two_loads_sql()} select "
          + ", ".join("cast(transaction_amount as double) as transaction_amount" if c == "transaction_amount" else c for c in FACT_OUT)
          + " from n_fact")


# F_RAW column -> header of a delivered file. Product type and segment keep their
# canonical names (a file may carry them); the name arrives as First Name / Last Name.
DELIVERY_HEADERS = {
    "id": "id",
    "customer_id": "Customer ID",
    "transaction_id": "TransactionID",
    "transaction_date": "Transaction Date",
    "product_type": "product_type",
    "transaction_amount": "Transaction Amount",
    "transaction_type": "Transaction Type",
    "account_type": "Account Type",
    "account_status": "Loan Status",
    "customer_name": "First Name",
    "customer_email": "Email",
    "customer_phone": "Contact Number",
    "customer_age": "Age",
    "customer_segment": "customer_segment",
    "branch_id": "Branch ID",
    "branch_location": "City",
}


def as_delivered(inputs, *more):
    """F_RAW in the shape of a delivered file (human headers, First/Last Name), built over
    ``fixtures.raw_inputs``; ``more`` columns of these stay."""
    raw = inputs.select(*fx.raw_columns(), *more)
    return raw.select(*[F.col(c).alias(h) for c, h in DELIVERY_HEADERS.items()], F.lit(None).cast("string").alias("Last Name"), *more)


def land_deliveries(spark, sf_dir, root: str) -> tuple[str, str]:
    """Write F_RAW as two deliveries of CSV part files, rows in staging-id order."""
    inputs = fx.raw_inputs(spark, sf_dir)
    early = F.coalesce(fx.raw_date() < "1998", F.lit(False))
    d = F.when(early, F.lit(1)).otherwise(F.lit(2)).alias("delivery")
    # one write: range-partitioned on (delivery, id), so part files are in id order. The narrow inputs are
    # placed and sorted, the texts built afterwards: the bounds are sampled by a pass over all rows
    placed = inputs.select("*", d).repartitionByRange("delivery", "id").sortWithinPartitions("delivery", "id")
    (as_delivered(placed, "delivery")
        .write.partitionBy("delivery").option("header", True).csv(root))
    return f"{root}/delivery=1", f"{root}/delivery=2"


def hand_over(spark, delivery: str, landing: str) -> None:
    """The part files of a delivery, in id order as they were written, move into the watched folder. A
    delivery's name goes before theirs: one task may have written a file of the same name for each."""
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    fs = path(landing).getFileSystem(conf)
    fs.mkdirs(path(landing))
    for file in fs.listStatus(path(delivery)):
        name = file.getPath().getName()
        if name.startswith("part-") and not fs.rename(file.getPath(), path(f"{landing}/{delivery.rsplit('/', 1)[-1]}-{name}")):
            raise OSError(f"{name} of {delivery} did not reach {landing}")


@register("job_pipeline", ORACLE)
def _job_pipeline(spark, sf_dir):
    """R-1 twice over delivered CSV files: stage, clean, merge, load, check, audit."""
    root = scratch_path(spark, "job")
    first, second = land_deliveries(spark, sf_dir, f"{root}/landing")
    wh = f"{root}/warehouse"
    job.run(spark, [first], wh, now=NOW1, batch_id="B1", fmt="csv")
    job.run(spark, [second], wh, now=NOW2, batch_id="B2", fmt="csv")
    return job.read_table(spark, wh, job.FACT).select(*FACT_OUT)


@register("incremental_fact", ORACLE)
def _incremental_fact(spark, sf_dir):
    """I-1: the same deliveries through a file stream with availableNow, one run per landing."""
    root = scratch_path(spark, "stream")
    staging = f"{root}/outbox"
    first, second = land_deliveries(spark, sf_dir, staging)
    landing, wh, ckpt = f"{root}/landing", f"{root}/warehouse", f"{root}/checkpoint"
    # each delivery's part files land in the watched folder; one availableNow run each
    hand_over(spark, first, landing)
    incremental.run_available(spark, landing, wh, ckpt, now=NOW1)
    hand_over(spark, second, landing)
    incremental.run_available(spark, landing, wh, ckpt, now=NOW2)
    return job.read_table(spark, wh, job.FACT).select(*FACT_OUT)
