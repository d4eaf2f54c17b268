"""Registered report queries (A-1 .. A-7, Q-10) over the driver tables."""

from __future__ import annotations

from txmart.plans import reports
from txmart.plans.oracle_sql import avg6, r2
from txmart.plans.registry import _t, register
from txmart.sources import tables as tb


# ---------------------------------------------------------------- reports over driver tables

@register(
    "customer_summary",
    f"""
    SELECT c.c_custkey AS customer_key, c.c_name AS customer_name, c.c_mktsegment AS customer_segment,
           count(DISTINCT CAST(o.o_orderkey AS VARCHAR)) AS transaction_count,
           CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
           {avg6("CAST(o.o_totalprice AS DECIMAL(18,2))")} AS avg_amount,
           max(CAST(o.o_orderdate AS DATE)) AS last_transaction
    FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
    GROUP BY c.c_custkey, c.c_name, c.c_mktsegment
    ORDER BY total_amount DESC NULLS FIRST, customer_key
    LIMIT 20
    """,
)
def _customer_summary(spark, sf_dir):
    """A-1 over customer ⟕ orders: top 20 customers by total amount."""
    return reports.customer_summary(
        tb.customers_as_dim(_t(spark, sf_dir, "customer")), tb.orders_as_fact(_t(spark, sf_dir, "orders"))
    )


@register(
    "product_performance",
    f"""
    with t as (select l.l_partkey as product_key, o.o_custkey as customer_key,
                 concat_ws('-', cast(l.l_orderkey as varchar), cast(l.l_linenumber as varchar)) as transaction_id,
                 cast(l.l_extendedprice as decimal(18,2)) as transaction_amount
               from lineitem l join orders o on l.l_orderkey = o.o_orderkey)
    select p.p_partkey as product_key, p.p_type as product_type, p.p_name as product_name,
      count(distinct t.transaction_id) as transaction_count, cast(sum(t.transaction_amount) as double) as total_volume,
      {avg6('t.transaction_amount')} as avg_transaction, count(distinct t.customer_key) as customer_count,
      round(100.0 * count(distinct t.customer_key) / (select count(distinct customer_key) from t), 2) as customer_penetration_pct
    from part p left join t on p.p_partkey = t.product_key
    group by p.p_partkey, p.p_type, p.p_name
    """,
)
def _product_performance(spark, sf_dir):
    """A-2 over part ⟕ (lineitem ⋈ orders): per part, line items, volume, customers, penetration."""
    fact = tb.lineitems_as_fact(_t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "orders"))
    return reports.product_performance(tb.parts_as_dim(_t(spark, sf_dir, "part")), fact)


@register(
    "monthly_trend",
    f"""
    select cast(date_trunc('month', cast(o_orderdate as date)) as date) as month, count(distinct cast(o_orderkey as varchar)) as transactions,
      cast(sum(cast(o_totalprice as decimal(18,2))) as double) as volume,
      {avg6("cast(o_totalprice as decimal(18,2))")} as avg_transaction, count(distinct o_custkey) as active_customers
    from orders group by 1
    """,
)
def _monthly_trend(spark, sf_dir):
    """A-3 over orders: per month, orders, volume, average, active customers."""
    return reports.monthly_trend(tb.orders_as_fact(_t(spark, sf_dir, "orders")))


AS_OF = "2024-01-31 00:00:00"

_QM_SQL = """qm as (select event_id as quality_key, strftime(ts, '%Y%m%d_%H') as etl_batch_id,
    concat('table_', cast(user_id % 3 as varchar)) as table_name, upper(event_type) as metric_name,
    cast(value as decimal(18,4)) as metric_value, cast(value as decimal(7,2)) as metric_percentage, user_id as record_count,
    case event_type when 'error' then 'FAIL' when 'signup' then 'WARNING' else 'PASS' end as quality_status, ts as checked_at
  from events)"""

_RL_SQL = """rl as (select event_id as execution_id, cast(event_id as varchar) as etl_batch_id, ts as execution_start,
    case event_type when 'error' then 'FAILED' when 'signup' then 'WARNING' else 'SUCCESS' end as execution_status,
    user_id * 100 as rows_extracted, user_id * 90 as rows_loaded, user_id * 10 as rows_rejected,
    cast(floor(value * 10) as bigint) as execution_duration_seconds
  from events)"""


def _qm(spark, sf_dir):
    return tb.events_as_quality_metrics(_t(spark, sf_dir, "events"))


def _rl(spark, sf_dir):
    return tb.events_as_run_log(_t(spark, sf_dir, "events"))


@register(
    "quality_trend",
    f"""
    with {_QM_SQL}
    select cast(checked_at as date) as check_date, quality_status, count(*) as metric_count,
      round(avg(metric_percentage), 2) as avg_quality_pct
    from qm where checked_at >= timestamp '{AS_OF}' - interval 30 day
    group by 1, 2
    """,
)
def _quality_trend(spark, sf_dir):
    """A-4 over events as quality metrics: per day and status, last 30 days."""
    return reports.quality_trend(_qm(spark, sf_dir), as_of=AS_OF)


@register(
    "recent_metrics",
    f"""
    with {_QM_SQL}
    select quality_key, etl_batch_id, table_name, metric_name, cast(metric_value as double) as metric_value,
      cast(metric_percentage as double) as metric_percentage, record_count, quality_status, checked_at
    from qm where checked_at >= timestamp '{AS_OF}' - interval 7 day
    """,
)
def _recent_metrics(spark, sf_dir):
    """A-6: metric rows of the last 7 days."""
    return reports.recent_metrics(_qm(spark, sf_dir), as_of=AS_OF)


@register(
    "latest_batch_report",
    f"""
    with {_QM_SQL}
    select quality_key, etl_batch_id, table_name, metric_name, cast(metric_percentage as double) as metric_percentage, quality_status
    from qm where etl_batch_id = (select max(etl_batch_id) from qm)
    """,
)
def _latest_batch_report(spark, sf_dir):
    """A-7: metrics of the latest batch."""
    return reports.latest_batch_report(_qm(spark, sf_dir))


@register(
    "run_performance",
    f"""
    with {_RL_SQL}
    select cast(execution_start as date) as run_date, avg(execution_duration_seconds) as avg_duration_sec,
      max(execution_duration_seconds) as max_duration_sec, count(*) as total_runs,
      cast(sum(case when execution_status = 'SUCCESS' then 1 else 0 end) as bigint) as successful_runs,
      round(100.0 * sum(case when execution_status = 'SUCCESS' then 1 else 0 end) / count(*), 2) as success_rate_pct,
      cast(sum(rows_extracted) as bigint) as total_extracted, cast(sum(rows_loaded) as bigint) as total_loaded,
      cast(sum(rows_rejected) as bigint) as total_rejected
    from rl where execution_start >= timestamp '{AS_OF}' - interval 30 day
    group by 1
    """,
)
def _run_performance(spark, sf_dir):
    """A-5 over events as the run log: per day, durations, success rate, row totals."""
    return reports.run_performance(_rl(spark, sf_dir), as_of=AS_OF)


@register(
    "run_rates",
    f"""
    with {_RL_SQL}
    select execution_id, etl_batch_id, rows_extracted as total, rows_loaded as processed, rows_rejected as failed,
      case when rows_extracted > 0 then {r2('cast(rows_loaded as double) / rows_extracted * 100')} else 0 end as success_rate,
      case when rows_extracted > 0 then {r2('cast(rows_rejected as double) / rows_extracted * 100')} else 0 end as failure_rate,
      case when execution_duration_seconds < 60 then concat(cast(execution_duration_seconds as varchar), 's')
           when execution_duration_seconds < 3600 then concat(cast(execution_duration_seconds // 60 as varchar), 'm ', cast(execution_duration_seconds % 60 as varchar), 's')
           else concat(cast(execution_duration_seconds // 3600 as varchar), 'h ', cast((execution_duration_seconds % 3600) // 60 as varchar), 'm') end as duration_text
    from rl
    """,
)
def _run_rates(spark, sf_dir):
    """Q-10: success/failure rate and duration text per run."""
    return reports.run_rates(_rl(spark, sf_dir))
