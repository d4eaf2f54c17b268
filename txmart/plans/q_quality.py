"""Registered quality queries (Q-1 .. Q-8, J-6) over the driver tables and the built mart."""

from __future__ import annotations

from pyspark.sql import functions as F

from txmart.operators import quality as q
from txmart.plans import fixtures as fx
from txmart.plans.oracle_sql import one_load_sql, r2
from txmart.plans.q_mart import one_load
from txmart.plans.registry import _t, register

METRIC = ["table_name", "metric_name", "metric_value", "metric_percentage", "record_count", "quality_status"]
LINEITEM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate"]
RAW = ["id", "customer_id", "transaction_id", "transaction_date", "product_type", "transaction_amount", "transaction_type",
       "account_type", "account_status", "customer_name", "customer_email", "customer_phone", "customer_age",
       "customer_segment", "branch_id", "branch_location"]


def _completeness_sql(table: str, src: str, cols) -> str:
    nulls = " + ".join(f"(count(*) - count({c}))" for c in cols)
    k = len(cols)
    pct = f"case when count(*) * {k} > 0 then cast(count(*) * {k} - ({nulls}) as double) / (count(*) * {k}) * 100 else 0 end"
    return (
        f"select '{table}' as table_name, 'COMPLETENESS_PCT' as metric_name, {r2(pct)} as metric_value, "
        f"{r2(pct)} as metric_percentage, count(*) as record_count, "
        f"case when {pct} >= 95 then 'PASS' else 'FAIL' end as quality_status from {src}"
    )


def _null_pct_sql(table: str, src: str, cols) -> str:
    per = " + ".join(f"case when count(*) > 0 then cast(count(*) - count({c}) as double) / count(*) * 100 else 100 end" for c in cols)
    avg = f"(({per}) / {len(cols)})"
    return (
        f"select '{table}' as table_name, 'NULL_PERCENTAGE' as metric_name, {r2(avg)} as metric_value, "
        f"{r2(avg)} as metric_percentage, count(*) as record_count, "
        f"case when {avg} <= 5 then 'PASS' else 'FAIL' end as quality_status from {src}"
    )


def _dups_sql(table: str, src: str, keys) -> str:
    k = ", ".join(keys)
    return (
        f"select '{table}' as table_name, 'DUPLICATES' as metric_name, cast(coalesce(sum(case when n > 1 then n end), 0) as double) as metric_value, "
        f"case when coalesce(sum(n), 0) > 0 then {r2('cast(coalesce(sum(case when n > 1 then n end), 0) as double) / sum(n) * 100')} else 0 end as metric_percentage, "
        f"cast(coalesce(sum(n), 0) as bigint) as record_count, case when coalesce(sum(case when n > 1 then n end), 0) = 0 then 'PASS' else 'WARNING' end as quality_status "
        f"from (select {k}, count(*) as n from {src} group by {k})"
    )


@register("dq_completeness", _completeness_sql("lineitem", "lineitem", LINEITEM))
def _dq_completeness(spark, sf_dir):
    """Q-1 on lineitem."""
    return q.completeness(_t(spark, sf_dir, "lineitem").select(*LINEITEM), "lineitem").select(*METRIC)


@register("dq_null_pct", f"with raw as ({fx.F_RAW_SQL}) " + _null_pct_sql("raw_banking_data", "raw", RAW))
def _dq_null_pct(spark, sf_dir):
    """Q-2 on the staged batch (phone is always null, so it FAILs)."""
    return q.null_percentages(fx.raw_transactions(spark, sf_dir), "raw_banking_data").select(*METRIC)


@register("dq_duplicates", _dups_sql("lineitem", "lineitem", ["l_orderkey", "l_linenumber"]))
def _dq_duplicates(spark, sf_dir):
    """Q-3 on lineitem's (l_orderkey, l_linenumber): every member of a repeated key counts."""
    return q.duplicates(_t(spark, sf_dir, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]).select(*METRIC)


@register(
    "dq_raw_suite",
    f"with raw as ({fx.F_RAW_SQL}) "
    + " union all ".join(
        [
            _completeness_sql("raw_banking_data", "raw", RAW[1:]),
            _null_pct_sql("raw_banking_data", "raw", RAW[1:]),
            _dups_sql("raw_banking_data", "raw", ["customer_id", "transaction_id", "transaction_date"]),
        ]
    ),
)
def _dq_raw_suite(spark, sf_dir):
    """Q-7 with a frame: completeness, null % and duplicates of the 15 staged columns."""
    return q.raw_suite(fx.raw_transactions(spark, sf_dir).drop("id")).select(*METRIC)


@register(
    "dq_orphans",
    """
    select 'lineitem_order_fk' as name, count(*) as orphaned_records from lineitem l where not exists (select 1 from orders o where o.o_orderkey = l.l_orderkey)
    union all select 'lineitem_part_fk', count(*) from lineitem l where not exists (select 1 from part p where p.p_partkey = l.l_partkey)
    union all select 'lineitem_supplier_fk', count(*) from lineitem l where not exists (select 1 from supplier s where s.s_suppkey = l.l_suppkey)
    union all select 'orders_customer_fk', count(*) from orders o where not exists (select 1 from customer c where c.c_custkey = o.o_custkey)
    union all select 'customer_nation_fk', count(*) from customer c where not exists (select 1 from nation n where n.n_nationkey = c.c_nationkey)
    """,
)
def _dq_orphans(spark, sf_dir):
    """J-6: orphan counts of the foreign keys between the driver tables."""
    t = lambda n: _t(spark, sf_dir, n)
    li, o = t("lineitem"), t("orders")
    return q.orphan_counts(
        [
            ("lineitem_order_fk", li, "l_orderkey", o, "o_orderkey"),
            ("lineitem_part_fk", li, "l_partkey", t("part"), "p_partkey"),
            ("lineitem_supplier_fk", li, "l_suppkey", t("supplier"), "s_suppkey"),
            ("orders_customer_fk", o, "o_custkey", t("customer"), "c_custkey"),
            ("customer_nation_fk", t("customer"), "c_nationkey", t("nation"), "n_nationkey"),
        ]
    )


_EXPECTED_LINEITEM = {"l_orderkey": "bigint", "l_quantity": "double", "l_shipdate": "timestamp", "l_linenumber": "int", "l_comment": "string"}


@register(
    "dq_schema",
    """
    select 'lineitem' as table_name, 'SCHEMA_VALIDATION' as metric_name, cast(null as double) as metric_value,
      cast(null as double) as metric_percentage, count(*) as record_count, 'FAIL' as quality_status from lineitem
    """,
)
def _dq_schema(spark, sf_dir):
    """Q-4 on lineitem: types match, ``l_comment`` is missing -> FAIL."""
    return q.schema_validation(_t(spark, sf_dir, "lineitem"), "lineitem", _EXPECTED_LINEITEM).select(*METRIC)


_FACT_COLS = ["transaction_id", "customer_key", "product_key", "time_key", "transaction_amount", "transaction_date"]
_CLEAN_COLS = ["customer_id", "transaction_id", "transaction_date", "transaction_amount"]


@register(
    "dq_suite",
    f"with {one_load_sql('B1')} "
    + " union all ".join(
        [
            _completeness_sql("fact_transactions", "m_fact", _FACT_COLS),
            _null_pct_sql("fact_transactions", "m_fact", _FACT_COLS),
            _dups_sql("fact_transactions", "m_fact", ["transaction_id"]),
            _completeness_sql("cleaned_banking_data", "cleaned", _CLEAN_COLS),
            _null_pct_sql("cleaned_banking_data", "cleaned", _CLEAN_COLS),
            _dups_sql("cleaned_banking_data", "cleaned", ["customer_id", "transaction_id", "transaction_date"]),
            "select 'fact_transactions', 'SCHEMA_VALIDATION', cast(null as double), cast(null as double), count(*), 'PASS' from m_fact",
            "select 'fact_transactions', 'REFERENTIAL_INTEGRITY', cast("
            "(select count(*) from m_fact f where not exists (select 1 from m_dim_customers d where d.customer_key = f.customer_key))"
            " + (select count(*) from m_fact f where not exists (select 1 from m_dim_products d where d.product_key = f.product_key))"
            " + (select count(*) from m_fact f where not exists (select 1 from m_dim_time d where d.time_key = f.time_key))"
            " + (select count(*) from m_fact f where f.branch_key is not null and not exists (select 1 from m_dim_branches d where d.branch_key = f.branch_key))"
            " as double), cast(null as double), cast(null as bigint), 'PASS'",
        ]
    ),
)
def _dq_suite(spark, sf_dir):
    """Q-7 after a load: Q-1..Q-3 on fact and cleaned, Q-4 on the fact, Q-5 fact -> dims."""
    m = one_load(spark, sf_dir)
    dims = {"customers": m.customers, "products": m.products, "time": m.time, "branches": m.branches}
    return q.mart_suite(m.fact, m.cleaned, dims).select(*METRIC)


@register(
    "dq_overall",
    f"with raw as ({fx.F_RAW_SQL}), m as ("
    + " union all ".join(
        [
            _completeness_sql("raw_banking_data", "raw", RAW[1:]),
            _null_pct_sql("raw_banking_data", "raw", RAW[1:]),
            _dups_sql("raw_banking_data", "raw", ["customer_id", "transaction_id", "transaction_date"]),
        ]
    )
    + ") select case max(case quality_status when 'PASS' then 0 when 'WARNING' then 1 when 'FAIL' then 2 end) "
    "when 0 then 'PASS' when 1 then 'WARNING' when 2 then 'FAIL' else 'PASS' end as overall_status, "
    "coalesce(max(case quality_status when 'PASS' then 0 when 'WARNING' then 1 when 'FAIL' then 2 end), 0) = 0 as passed from m",
)
def _dq_overall(spark, sf_dir):
    """Q-6: the folded status of the staged-batch suite (passed = exactly PASS)."""
    return q.overall_status(q.raw_suite(fx.raw_transactions(spark, sf_dir).drop("id")))


@register(
    "smoke_counts",
    f"with {one_load_sql('B1')} "
    "select 'staging.raw_banking_data' as table_name, 'SMOKE_COUNT_RAW' as metric_name, cast(count(*) as double) as metric_value, "
    "cast(null as double) as metric_percentage, count(*) as record_count, 'PASS' as quality_status from raw "
    "union all select 'staging.cleaned_banking_data', 'SMOKE_COUNT_CLEANED', count(*), null, count(*), 'PASS' from cleaned "
    "union all select 'mart.fact_transactions', 'SMOKE_COUNT_FACT', count(*), null, count(*), 'PASS' from m_fact",
)
def _smoke_counts(spark, sf_dir):
    """Q-8: row counts of raw, cleaned and fact as metric rows."""
    m = one_load(spark, sf_dir)
    raw = fx.raw_transactions(spark, sf_dir)
    return q.smoke_counts(
        {
            "staging.raw_banking_data": ("SMOKE_COUNT_RAW", raw),
            "staging.cleaned_banking_data": ("SMOKE_COUNT_CLEANED", m.cleaned),
            "mart.fact_transactions": ("SMOKE_COUNT_FACT", m.fact),
        }
    ).select(*METRIC)
