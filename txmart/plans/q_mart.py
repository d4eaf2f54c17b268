"""Registered mart queries (K-1, D-*, J-*, S-9, S-10 and reports over the built mart)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from txmart.operators import dims as dm
from txmart.operators import fact as fc
from txmart.operators.keys import assign_keys
from txmart.plans import fixtures as fx
from txmart.plans import reports
from txmart.plans.mart import build_mart, seeded_mart
from txmart.plans.oracle_sql import avg6, one_load_sql, two_loads_sql
from txmart.plans.registry import _t, register

NOW1 = dt.datetime(2024, 2, 1, 2, 0, 0)
NOW2 = dt.datetime(2024, 2, 2, 2, 0, 0)

CUSTOMER_COLS = "customer_key, customer_id, customer_name, customer_email, customer_phone, customer_age, customer_segment, is_active"
PRODUCT_COLS = "product_key, product_id, product_type, product_name, product_category, is_active"
BRANCH_COLS = "branch_key, branch_id, branch_name, branch_location, is_active"
TIME_COLS = "time_key, date, year, quarter, month, day, day_of_week, day_name, month_name, week_of_year, is_weekend"
FACT_COLS = (
    "transaction_key, customer_key, product_key, time_key, branch_key, transaction_id, account_id, transaction_amount, "
    "transaction_type, account_type, account_status, transaction_date, etl_batch_id"
)
# the same columns in oracle SQL, money as double like the portable Spark output
FACT_SQL = FACT_COLS.replace("transaction_amount,", "cast(transaction_amount as double) as transaction_amount,")


def _cols(s: str):
    return [c.strip() for c in s.split(",")]


def one_load(spark, sf_dir):
    """F_RAW staged and loaded once into a freshly seeded mart."""
    return build_mart(fx.raw_transactions(spark, sf_dir), seeded_mart(spark), "B1", NOW1)


def two_loads(spark, sf_dir):
    """F_RAW delivered as two nightly batches: order dates before 1998, then the rest."""
    raw = fx.raw_transactions(spark, sf_dir)
    early = F.coalesce(F.col("transaction_date") < "1998", F.lit(False))
    m1 = build_mart(raw.where(early), seeded_mart(spark), "B1", NOW1)
    state = {"customers": m1.customers, "products": m1.products, "branches": m1.branches, "time": m1.time, "fact": m1.fact}
    return build_mart(raw.where(~early), state, "B2", NOW2)


@register("dim_customers", f"with {one_load_sql('B1')} select {CUSTOMER_COLS} from m_dim_customers")
def _dim_customers(spark, sf_dir):
    """D-2/D-8/K-1: customers merged from the cleaned batch over the unknown member."""
    return one_load(spark, sf_dir).customers.select(*_cols(CUSTOMER_COLS))


@register("dim_products", f"with {one_load_sql('B1')} select {PRODUCT_COLS} from m_dim_products")
def _dim_products(spark, sf_dir):
    """D-3: products (id = type = name, category BANKING)."""
    return one_load(spark, sf_dir).products.select(*_cols(PRODUCT_COLS))


@register("dim_branches", f"with {one_load_sql('B1')} select {BRANCH_COLS} from m_dim_branches")
def _dim_branches(spark, sf_dir):
    """D-4: branches (no unknown member, keys from 1)."""
    return one_load(spark, sf_dir).branches.select(*_cols(BRANCH_COLS))


@register("dim_time", f"with {one_load_sql('B1')} select {TIME_COLS} from m_dim_time")
def _dim_time(spark, sf_dir):
    """D-5: one calendar row per transaction date (ISO day of week and week)."""
    return one_load(spark, sf_dir).time.select(*_cols(TIME_COLS))


@register("fact_transactions", f"with {one_load_sql('B1')} select {FACT_SQL} from m_fact")
def _fact_transactions(spark, sf_dir):
    """D-9/J-1/J-2: first row per transaction id, dimension keys with unknown members."""
    return one_load(spark, sf_dir).fact.select(*_cols(FACT_COLS))


@register("fact_second_load", f"with {two_loads_sql()} select {FACT_SQL} from n_fact")
def _fact_second_load(spark, sf_dir):
    """D-9 across two loads: keys continue, existing transaction ids are not re-inserted."""
    return two_loads(spark, sf_dir).fact.select(*_cols(FACT_COLS))


@register("upsert_customers", f"with {two_loads_sql()} select {CUSTOMER_COLS} from n_dim_customers")
def _upsert_customers(spark, sf_dir):
    """D-1 across two loads: existing customers overwritten (latest wins), new ones keyed."""
    return two_loads(spark, sf_dir).customers.select(*_cols(CUSTOMER_COLS))


@register("insert_if_absent", f"with {two_loads_sql()} select {TIME_COLS} from n_dim_time")
def _insert_if_absent(spark, sf_dir):
    """J-5 across two loads: dates already present are untouched, new ones appended."""
    return two_loads(spark, sf_dir).time.select(*_cols(TIME_COLS))


@register(
    "surrogate_keys",
    """
    select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, row_number() over (order by l_orderkey, l_linenumber) as line_key
    from (select distinct l_orderkey, l_linenumber from lineitem)
    """,
)
def _surrogate_keys(spark, sf_dir):
    """K-1: dense keys in natural-key order without a single-partition window."""
    pairs = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    return assign_keys(pairs, "line_key", ["l_orderkey", "l_linenumber"])


@register(
    "calendar_orders",
    """
    with b as (select cast(min(o_orderdate) as date) as lo, cast(max(o_orderdate) as date) as hi from orders),
    d as (select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as date from b)
    select date, year(date) as year, quarter(date) as quarter, month(date) as month, day(date) as day,
      dayofweek(date) as day_of_week, dayname(date) as day_name, monthname(date) as month_name,
      week(date) as week_of_year, dayofweek(date) in (0, 6) as is_weekend
    from d
    """,
)
def _calendar_orders(spark, sf_dir):
    """D-6: a calendar over the order-date range, Sunday=0 numbering."""
    b = _t(spark, sf_dir, "orders").agg(F.min("o_orderdate").cast("date").alias("lo"), F.max("o_orderdate").cast("date").alias("hi"))
    days = b.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return dm.time_rows(days, "date", "sunday0")


@register(
    "mark_processed",
    f"""
    with raw as ({fx.F_RAW_SQL})
    select id, true as is_processed, timestamp '2024-02-01 02:00:00' as processed_at from raw
    """,
)
def _mark_processed(spark, sf_dir):
    """S-7/S-9: every staged row taken by the run is flagged processed, kept or not."""
    raw = fx.raw_transactions(spark, sf_dir).withColumns(
        {"is_processed": F.lit(False), "processed_at": F.lit(None).cast("timestamp_ntz")}
    )
    batch, cutoff = fc.take_unprocessed(raw)
    return fc.mark_processed(raw, cutoff, NOW1).select("id", "is_processed", "processed_at")


@register(
    "mark_loaded",
    f"""
    with {one_load_sql('B1')}
    select c.source_row_id, c.transaction_id,
      exists (select 1 from m_fact f where f.transaction_id = c.transaction_id) as is_loaded
    from cleaned c
    """,
)
def _mark_loaded(spark, sf_dir):
    """S-10: cleaned rows whose transaction id is now in the fact are flagged loaded."""
    m = one_load(spark, sf_dir)
    return fc.mark_loaded(m.cleaned, m.fact, NOW1).select("source_row_id", "transaction_id", "is_loaded")


@register(
    "dimension_counts",
    f"""
    with {one_load_sql('B1')}
    select 'customers' as dimension, count(*) as row_count from m_dim_customers
    union all select 'products', count(*) from m_dim_products
    union all select 'branches', count(*) from m_dim_branches
    union all select 'time', count(*) from m_dim_time
    """,
)
def _dimension_counts(spark, sf_dir):
    """D-10: rows per dimension after a load."""
    m = one_load(spark, sf_dir)
    return dm.dimension_counts(customers=m.customers, products=m.products, branches=m.branches, time=m.time)


# ---------------------------------------------------------------- reports over the built mart

@register(
    "mart_customer_summary",
    f"""
    with {one_load_sql('B1')}
    select c.customer_key, c.customer_name, c.customer_segment, count(distinct t.transaction_id) as transaction_count,
      cast(sum(t.transaction_amount) as double) as total_amount, {avg6('t.transaction_amount')} as avg_amount,
      max(t.transaction_date) as last_transaction
    from m_dim_customers c left join m_fact t on c.customer_key = t.customer_key
    where c.is_active
    group by c.customer_key, c.customer_name, c.customer_segment
    order by total_amount desc nulls first, c.customer_key
    limit 20
    """,
)
def _mart_customer_summary(spark, sf_dir):
    """A-1 over the mart: the unknown member has no facts and sorts first (NULLS FIRST)."""
    m = one_load(spark, sf_dir)
    return reports.customer_summary(m.customers, m.fact)


@register(
    "mart_product_performance",
    f"""
    with {one_load_sql('B1')}
    select p.product_key, p.product_type, p.product_name, count(distinct t.transaction_id) as transaction_count,
      cast(sum(t.transaction_amount) as double) as total_volume, {avg6('t.transaction_amount')} as avg_transaction,
      count(distinct t.customer_key) as customer_count,
      round(100.0 * count(distinct t.customer_key) / (select count(distinct customer_key) from m_fact), 2)
        as customer_penetration_pct
    from m_dim_products p left join m_fact t on p.product_key = t.product_key
    where p.is_active
    group by p.product_key, p.product_type, p.product_name
    """,
)
def _mart_product_performance(spark, sf_dir):
    """A-2 over the mart, penetration against all fact customers."""
    m = one_load(spark, sf_dir)
    return reports.product_performance(m.products, m.fact)


@register(
    "mart_monthly_trend",
    f"""
    with {one_load_sql('B1')}
    select cast(date_trunc('month', transaction_date) as date) as month, count(distinct transaction_id) as transactions,
      cast(sum(transaction_amount) as double) as volume, {avg6('transaction_amount')} as avg_transaction,
      count(distinct customer_key) as active_customers
    from m_fact group by 1
    """,
)
def _mart_monthly_trend(spark, sf_dir):
    """A-3 over the mart."""
    return reports.monthly_trend(one_load(spark, sf_dir).fact)
