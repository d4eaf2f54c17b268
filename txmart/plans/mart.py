"""Building the mart from a staged batch: clean -> dimensions -> fact.

``build_mart`` is the batch core of the job (R-1) as pure DataFrame functions: it takes the
staged rows and the current mart tables and returns the next version of each. The cleaned
batch is checkpointed once (to the shared checkpoint folder) so the four dimension merges
and the fact load do not repeat the cleaning.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmart import schemas
from txmart.operators import dims as dm
from txmart.operators.clean import clean_transactions
from txmart.operators.fact import new_facts
from txmart.session import ensure_checkpoint_dir
from txmart.settings import Settings


@dataclass
class Mart:
    cleaned: DataFrame
    customers: DataFrame
    products: DataFrame
    branches: DataFrame
    time: DataFrame
    fact: DataFrame
    new_facts: DataFrame


def seeded_mart(spark: SparkSession) -> dict[str, DataFrame]:
    """S-13: empty tables with the unknown members, as a first run sees them."""
    return {
        "customers": dm.seed_customers(spark),
        "products": dm.seed_products(spark),
        "branches": dm.seed_branches(spark),
        "time": dm.seed_time(spark),
        "fact": dm.empty(spark, schemas.FACT),
    }


def cleaned_layer(cleaned: DataFrame, now) -> DataFrame:
    """Cleaned rows with the cleaned-table bookkeeping columns."""
    ts = F.lit(now).cast("timestamp_ntz")
    return cleaned.withColumns(
        {"is_loaded": F.lit(False), "loaded_at": F.lit(None).cast("timestamp_ntz"), "created_at": ts}
    )


def build_mart(
    raw: DataFrame,
    current: dict[str, DataFrame],
    batch_id: str,
    now: dt.datetime,
    settings: Settings | None = None,
    date_mode: str | None = None,
) -> Mart:
    s = settings or Settings()
    ensure_checkpoint_dir(raw.sparkSession)
    cleaned = cleaned_layer(clean_transactions(raw, s, date_mode), now).checkpoint(eager=True)
    # the four merges are independent jobs; submit them side by side
    with ThreadPoolExecutor(max_workers=4) as pool:
        futures = [
            pool.submit(lambda: dm.merge_customers(current["customers"], cleaned, now=now).checkpoint(eager=True)),
            pool.submit(lambda: dm.merge_products(current["products"], cleaned, now=now).checkpoint(eager=True)),
            pool.submit(lambda: dm.merge_branches(current["branches"], cleaned, now=now).checkpoint(eager=True)),
            pool.submit(lambda: dm.merge_time(current["time"], cleaned).checkpoint(eager=True)),
        ]
        customers, products, branches, time = [f.result() for f in futures]
    added = new_facts(cleaned, customers, products, time, branches, current["fact"], batch_id, now)
    return Mart(cleaned, customers, products, branches, time, current["fact"].unionByName(added), added)
