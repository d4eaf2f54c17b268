"""Registered queries whose inputs reach the behaviour they are named after: re-sent
transactions with changed attributes, keys without members, parents cut away, time windows
that cut, limits that bite, dirty files and dates, and the audit rows of whole job runs.
"""

from __future__ import annotations

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from txmart import schemas
from txmart.functions.text import null_if_na, trim_ws
from txmart.functions.values import batch_id_of, rate_pct
from txmart.operators import bitmaps
from txmart.operators import clean as cl
from txmart.operators import dims as dm
from txmart.operators import fact as fc
from txmart.operators import quality as q
from txmart.operators.conform import conform
from txmart.plans import fixtures as fx
from txmart.plans import job, reports
from txmart.plans import q_reports as qr
from txmart.plans.mart import build_mart, seeded_mart
from txmart.plans.oracle_sql import FIRST_LOAD, SEED_CTES, cleaned_ctes, mart_ctes, one_load_sql
from txmart.plans.q_job import land_deliveries
from txmart.plans.q_mart import CUSTOMER_COLS, FACT_COLS, FACT_SQL, NOW1, NOW2, TIME_COLS, _cols, one_load
from txmart.plans.q_quality import METRIC, RAW, _completeness_sql, _dups_sql, _null_pct_sql
from txmart.plans.registry import _t, register
from txmart.session import scratch_path
from txmart.settings import NA_TOKENS, Settings
from txmart.sources import files
from txmart.sources import tables as tb
from txmart.sources.staging import new_files, persist_cleaned
from txmart.sources.warehouse import Warehouse

# ---------------------------------------------------------------- two loads with re-sends

_RESENT = {
    "id": "id + 30000000", "customer_name": "concat(customer_name, 'resent')", "customer_segment": "'RESENT'",
    "transaction_amount": "'$1.00'", "branch_id": "'BRN999'", "branch_location": "'elsewhere'",
}


def _resends(raw):
    early = F.coalesce(F.col("transaction_date") < "1998", F.lit(False))
    again = raw.where(early & (F.col("id") % 30 == 0))
    return raw.where(early), raw.where(~early).unionByName(again.withColumns({c: F.expr(e) for c, e in _RESENT.items()}))


def _resend_sql() -> str:
    cols = [f.name for f in schemas.TABLES["staging.raw_banking_data"].fields][:16]
    again = ", ".join(f"{_RESENT[c]} as {c}" if c in _RESENT else c for c in cols)
    second = {k: v.replace("seed_", "m_dim_") for k, v in FIRST_LOAD.items()} | {"fact": "m_fact"}
    return (
        f"raw as ({fx.F_RAW_SQL}), raw1 as (select * from raw where transaction_date < '1998'),"
        f"raw2 as (select {', '.join(cols)} from raw where not coalesce(transaction_date < '1998', false)"
        f" union all select {again} from raw1 where id % 30 = 0),"
        + cleaned_ctes("raw1", "a_") + "," + cleaned_ctes("raw2", "b_") + "," + SEED_CTES + ","
        + mart_ctes("a_cleaned", "m_", FIRST_LOAD, "B1") + "," + mart_ctes("b_cleaned", "n_", second, "B2")
    )


def _two_loads(spark, sf_dir):
    first, second = _resends(fx.raw_transactions(spark, sf_dir))
    m = build_mart(first, seeded_mart(spark), "B1", NOW1)
    return build_mart(second, {"customers": m.customers, "products": m.products, "branches": m.branches, "time": m.time, "fact": m.fact}, "B2", NOW2)


@register("resent_facts", f"with {_resend_sql()} select {FACT_SQL} from n_fact")
def _resent_facts(spark, sf_dir):
    """D-9: transaction ids of the first load, sent again with another amount, change nothing."""
    return _two_loads(spark, sf_dir).fact.select(*_cols(FACT_COLS))


@register("resent_customers", f"with {_resend_sql()} select {CUSTOMER_COLS} from n_dim_customers")
def _resent_customers(spark, sf_dir):
    """D-1: the second delivery overwrites name and segment of customers it sends again."""
    return _two_loads(spark, sf_dir).customers.select(*_cols(CUSTOMER_COLS))


@register("resent_dates", f"with {_resend_sql()} select {TIME_COLS} from n_dim_time")
def _resent_dates(spark, sf_dir):
    """J-5: dates that come again are left alone."""
    return _two_loads(spark, sf_dir).time.select(*_cols(TIME_COLS))


# ---------------------------------------------------------------- unknown members, flags, inserts

_MEMBERLESS = [c for c in _cols(FACT_COLS) if c != "etl_batch_id"]


@register(
    "unknown_members",
    f"""
    with {one_load_sql('B1')},
    j as (
      select coalesce(dc.customer_key, 1) as customer_key, coalesce(dp.product_key, 1) as product_key, coalesce(dt.time_key, 1) as time_key,
        db.branch_key, c.transaction_id, c.customer_id as account_id, c.transaction_amount, c.transaction_type, c.account_type, c.account_status,
        cast(c.transaction_date as date) as transaction_date, row_number() over (partition by c.transaction_id order by c.source_row_id) as rn
      from cleaned c
      left join (select * from m_dim_customers where customer_key % 7 <> 0) dc on c.customer_id = dc.customer_id
      left join (select * from m_dim_products where product_key % 2 = 0) dp on c.product_type = dp.product_type
      left join (select * from m_dim_time where day <> 13) dt on cast(c.transaction_date as date) = dt.date
      left join (select * from m_dim_branches where branch_key % 3 <> 0) db on c.branch_id = db.branch_id)
    select row_number() over (order by transaction_id) as transaction_key, customer_key, product_key, time_key, branch_key, transaction_id, account_id,
      cast(transaction_amount as double) as transaction_amount, transaction_type, account_type, account_status, transaction_date
    from j where rn = 1
    """,
)
def _unknown_members(spark, sf_dir):
    """J-2: facts whose customer, product, date or branch has no member (dimensions cut)."""
    m = one_load(spark, sf_dir)
    facts = fc.new_facts(m.cleaned, m.customers.where("customer_key % 7 <> 0"), m.products.where("product_key % 2 = 0"),
                         m.time.where("day <> 13"), m.branches.where("branch_key % 3 <> 0"), seeded_mart(spark)["fact"], "B1", NOW1)
    return facts.select(*_MEMBERLESS)


@register(
    "run_flags",
    f"""
    with raw as ({fx.F_RAW_SQL}), top as (select max(o_orderkey) as hi from orders)
    select id, id <= hi * 2 // 3 as is_processed,
      case when id <= hi // 3 then timestamp '2024-02-01 02:00:00' when id <= hi * 2 // 3 then timestamp '2024-02-02 02:00:00' end as processed_at
    from raw cross join top
    """,
)
def _run_flags(spark, sf_dir):
    """S-9/S-10 as the job derives them: two run marks cover two thirds of the ids."""
    hi = _t(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    marks = spark.createDataFrame([("B1", hi // 3, hi // 3, NOW1), ("B2", hi * 2 // 3, hi * 2 // 3, NOW2)], schemas.RUN_MARKS)
    raw = fx.raw_transactions(spark, sf_dir).select("id", F.lit(False).alias("is_processed"), F.lit(None).cast("timestamp_ntz").alias("processed_at"))
    return fc.with_run_flags(raw, marks, "id", "processed_through", "is_processed", "processed_at")


@register(
    "mark_loaded_some",
    f"""
    with {one_load_sql('B1')}
    select c.source_row_id, c.transaction_id,
      exists (select 1 from m_fact f where f.transaction_id = c.transaction_id and f.transaction_key % 3 = 0) as is_loaded
    from cleaned c
    """,
)
def _mark_loaded_some(spark, sf_dir):
    """S-10: only cleaned rows whose transaction id is in the fact are flagged."""
    m = one_load(spark, sf_dir)
    return fc.mark_loaded(m.cleaned, m.fact.where("transaction_key % 3 = 0"), NOW1).select("source_row_id", "transaction_id", "is_loaded")


@register(
    "persist_cleaned",
    f"with {one_load_sql('B1')} select source_row_id, transaction_id from cleaned where source_row_id % 4 <> 0",
)
def _persist_cleaned(spark, sf_dir):
    """S-8: rows whose source row id is already in the cleaned table are not stored again."""
    cleaned = one_load(spark, sf_dir).cleaned
    return persist_cleaned(cleaned, cleaned.where("source_row_id % 4 = 0")).select("source_row_id", "transaction_id")


@register(
    "redelivered_files",
    """
    select concat('/landing/', cast(o_orderkey as varchar), '.csv') as path, md5(cast(o_orderkey // 2 as varchar)) as source_file_hash
    from orders where o_orderkey // 2 not in (select o_orderkey // 2 from orders where o_orderkey % 7 = 0)
    """,
)
def _redelivered_files(spark, sf_dir):
    """I-2: files (one per order) whose hash is in the ledger are skipped, whatever their name."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("/landing/"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("path"),
                                           F.md5(F.floor(F.col("o_orderkey") / 2).cast("string").cast("binary")).alias("source_file_hash"))
    return new_files(o, o.where("o_orderkey % 7 = 0"))


# ---------------------------------------------------------------- quality with orphans, samples, windows

_CUT_ORPHANS = """
    select 'lineitem_order_fk' as name, count(*) as orphaned_records from lineitem where not exists (select 1 from orders where o_orderkey = l_orderkey and o_orderkey % 10 <> 0)
    union all select 'lineitem_part_fk', count(*) from lineitem where not exists (select 1 from part where p_partkey = l_partkey and p_partkey % 7 <> 0)
    union all select 'lineitem_supplier_fk', count(*) from lineitem where not exists (select 1 from supplier where s_suppkey = l_suppkey)
"""


def _cut_checks(spark, sf_dir):
    li, t = _t(spark, sf_dir, "lineitem"), lambda n: _t(spark, sf_dir, n)
    return [
        ("lineitem_order_fk", li, "l_orderkey", t("orders").where("o_orderkey % 10 <> 0"), "o_orderkey"),
        ("lineitem_part_fk", li, "l_partkey", t("part").where("p_partkey % 7 <> 0"), "p_partkey"),
        ("lineitem_supplier_fk", li, "l_suppkey", t("supplier"), "s_suppkey"),
    ]


@register("dq_orphans_cut", _CUT_ORPHANS)
def _dq_orphans_cut(spark, sf_dir):
    """J-6: orphans where parents were cut away, none where they were not."""
    return q.orphan_counts(_cut_checks(spark, sf_dir))


@register(
    "dq_referential_cut",
    f"""
    with o as ({_CUT_ORPHANS})
    select 'lineitem' as table_name, 'REFERENTIAL_INTEGRITY' as metric_name, cast(sum(orphaned_records) as double) as metric_value,
      cast(sum(orphaned_records) as double) as metric_percentage, cast(null as bigint) as record_count,
      case when max(orphaned_records) > 0 then 'WARNING' else 'PASS' end as quality_status from o
    """,
)
def _dq_referential_cut(spark, sf_dir):
    """Q-5: orphans make the check a WARNING."""
    return q.referential_integrity("lineitem", _cut_checks(spark, sf_dir)).select(
        "table_name", "metric_name", "metric_value", F.coalesce("metric_percentage", "metric_value").alias("metric_percentage"), "record_count", "quality_status")


@register("newest_sample", "select event_id, event_type from events order by date_trunc('day', ts) desc, event_id desc limit 300")
def _newest_sample(spark, sf_dir):
    """S-12: the newest 300 rows; whole days tie and the key decides."""
    ev = _t(spark, sf_dir, "events").select("event_id", "event_type", F.date_trunc("day", F.col("ts")).alias("created_at"))
    return q.sample_newest(ev, 300, tie_break="event_id").select("event_id", "event_type")


_LATER = "2024-02-14 00:00:00"


def _moved(name: str) -> str:
    from txmart.plans.registry import ORACLE_SQL

    return ORACLE_SQL[name].replace(qr.AS_OF, _LATER)


@register("quality_trend_cut", _moved("quality_trend"))
def _quality_trend_cut(spark, sf_dir):
    """A-4 with a window that leaves the older half of the rows out."""
    return reports.quality_trend(tb.events_as_quality_metrics(_t(spark, sf_dir, "events")), as_of=_LATER)


@register("run_performance_cut", _moved("run_performance"))
def _run_performance_cut(spark, sf_dir):
    """A-5 with a window that leaves the older half of the rows out."""
    return reports.run_performance(tb.events_as_run_log(_t(spark, sf_dir, "events")), as_of=_LATER)


def _with_gaps(name: str, table: str, condition: str) -> str:
    from txmart.plans.registry import ORACLE_SQL

    return re.sub(rf"\b{table}\b", f"(select * from {table} where {condition})", ORACLE_SQL[name])


@register("customer_summary_gaps", _with_gaps("customer_summary", "orders", "o_custkey % 50 <> 0").replace("LIMIT 20", "LIMIT 200"))
def _customer_summary_gaps(spark, sf_dir):
    """A-1 with customers that have no orders: they stay, with nulls, and sort first."""
    orders = _t(spark, sf_dir, "orders").where("o_custkey % 50 <> 0")
    return reports.customer_summary(tb.customers_as_dim(_t(spark, sf_dir, "customer")), tb.orders_as_fact(orders), top=200)


@register("product_performance_gaps", _with_gaps("product_performance", "lineitem", "l_partkey % 5 <> 0"))
def _product_performance_gaps(spark, sf_dir):
    """A-2 with products that nobody bought."""
    items = _t(spark, sf_dir, "lineitem").where("l_partkey % 5 <> 0")
    return reports.product_performance(tb.parts_as_dim(_t(spark, sf_dir, "part")), tb.lineitems_as_fact(items, _t(spark, sf_dir, "orders")))


# ---------------------------------------------------------------- dirty values and files

_TOKENS = [t for t in NA_TOKENS] + ["na ", "Null", "0", "none"]
_TOKEN_SQL = "[" + ", ".join(f"'{t}'" for t in _TOKENS) + f"][event_id % {len(_TOKENS)} + 1]"


@register("na_tokens", f"select event_id, case when event_id % {len(_TOKENS)} >= {len(NA_TOKENS)} then {_TOKEN_SQL} end as value from events")
def _na_tokens(spark, sf_dir):
    """S-2: each of the 19 tokens becomes null, near misses stay."""
    token = F.get(F.array(*[F.lit(t) for t in _TOKENS]), (F.col("event_id") % len(_TOKENS)).cast("int"))
    return _t(spark, sf_dir, "events").select("event_id", null_if_na(token).alias("value"))


@register(
    "batch_ids",
    """
    select event_id, strftime(ts, '%Y%m%d_%H%M%S_%g') as batch_id,
      case when user_id > 0 then cast(round(cast(event_id % 97 as decimal(38,18)) / user_id * 100, 2) as double) else 0 end as rate
    from events
    """,
)
def _batch_ids(spark, sf_dir):
    """Run ids from timestamps, and rates that differ from row to row (0 without a whole)."""
    ev = _t(spark, sf_dir, "events")
    return ev.select("event_id", batch_id_of("ts").alias("batch_id"), rate_pct(F.col("event_id") % 97, F.col("user_id")).alias("rate"))


@register("strip_unicode", "select c_custkey, c_name from customer")
def _strip_unicode(spark, sf_dir):
    """C-4: no-break, ideographic and line-separator blanks around a name go, inner ones stay."""
    name = F.concat(F.lit(" 　 \t"), F.col("c_name"), F.lit("  "))
    return _t(spark, sf_dir, "customer").select("c_custkey", trim_ws(name).alias("c_name"))


def _odd_dates(spark, sf_dir):
    """F_DATES with a bad first value, month names, and date-times mixed with dates."""
    d = fx.date_columns(spark, sf_dir)
    o = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderdate")
    first = o.agg(F.min("id").alias("_first"))
    j = d.join(o, "id").crossJoin(F.broadcast(first))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return j.select(
        "id", F.when(F.col("id") == F.col("_first"), "not-a-date").otherwise(F.col("d_us")).alias("bad_first"), F.date_format("o_orderdate", "MMM d, yyyy").alias("month_name"),
        F.when((F.col("id") == F.col("_first")) | (F.col("id") % 2 == 0), F.concat(day, F.lit(" 10:30:00"))).otherwise(day).alias("date_time"),
    )


@register(
    "odd_dates",
    """
    select o_orderkey as id, case when o_orderkey <> (select min(o_orderkey) from orders) then cast(cast(o_orderdate as date) as timestamp) end as bad_first,
      cast(cast(o_orderdate as date) as timestamp) as month_name,
      case when o_orderkey = (select min(o_orderkey) from orders) or o_orderkey % 2 = 0 then cast(cast(o_orderdate as date) as timestamp) + interval '10 hours 30 minutes' end as date_time
    from orders
    """,
)
def _odd_dates_query(spark, sf_dir):
    """C-2: after a value no format reads, each value is read by itself; a month-name column
    is read; a column that starts with a date-time loses plain dates, as in the source."""
    return cl.parse_dates(_odd_dates(spark, sf_dir), ("bad_first", "month_name", "date_time"))


@register(
    "csv_dialect",
    """
    select cast(o_orderkey as varchar) as id, concat('He said "hi", ', o_orderpriority, chr(10), 'then left') as note,
      case when o_orderkey % 3 = 1 then null when o_orderkey % 2 = 0 then 'Oslo' else 'Rome' end as city
    from orders
    """,
)
def _csv_dialect(spark, sf_dir):
    """S-1: doubled quotes, commas and line breaks in quoted fields, headers in another order
    and a file without one of the columns."""
    o = _t(spark, sf_dir, "orders")
    rows = o.select(F.col("o_orderkey").cast("string").alias("id"), F.concat(F.lit('He said "hi", '), F.col("o_orderpriority"), F.lit("\nthen left")).alias("note"),
                    F.when(F.col("o_orderkey") % 2 == 0, "Oslo").otherwise("Rome").alias("city"), (F.col("o_orderkey") % 3).alias("k"))
    root = scratch_path(spark, "csv")
    for k, cols in enumerate((["id", "note", "city"], ["id", "note"], ["city", "note", "id"])):
        rows.where(F.col("k") == k).select(*cols).write.option("header", True).option("escape", '"').csv(f"{root}/{k}")
    return files.read_source(spark, [f"{root}/{k}" for k in range(3)], "csv").select("id", "note", "city")


@register(
    "csv_blank_lines",
    """
    select cast(o_orderkey as varchar) as id, case when o_orderkey % 7 = 0 then concat('two', chr(10), 'lines') else o_orderpriority end as note,
      concat('part', cast(o_orderkey % 8 as varchar)) as part
    from orders
    """,
)
def _csv_blank_lines(spark, sf_dir):
    """S-1, S-3: files that begin with blank lines and have more between their rows, beside a
    file of a header alone and one of blank lines alone: every row of the others is read."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", (F.col("o_orderkey") % 8).alias("k"))
    note = F.when(F.col("o_orderkey") % 7 == 0, F.lit('"two\nlines"')).otherwise(F.col("o_orderpriority"))
    gap = F.when(F.col("o_orderkey") % 5 == 0, F.lit("\n  ")).otherwise(F.lit(""))
    line = F.concat(F.col("o_orderkey").cast("string"), F.lit(","), note, F.lit(",part"), F.col("k").cast("string"), gap)
    rows = o.select("k", F.col("o_orderkey").alias("at"), line.alias("value"))
    heads = spark.range(9).select(F.col("id").alias("k"), F.lit(-1).cast("long").alias("at"), F.lit("\n \nid,note,part").alias("value"))
    blank = spark.range(1).select(F.lit(9).cast("long").alias("k"), F.lit(0).cast("long").alias("at"), F.lit("\n  \n").alias("value"))
    root = scratch_path(spark, "blank")
    lines = rows.unionByName(heads).unionByName(blank)
    lines.repartition(10, "k").sortWithinPartitions("k", "at").select("k", "value").write.partitionBy("k").text(root)
    return files.read_source(spark, [f"{root}/k={k}" for k in range(10)], "csv").select("id", "note", "part")


@register(
    "distinct_by_year",
    """
    select year(o_orderdate) as year, count(distinct o_custkey) as customers, (select count(distinct o_custkey) from orders) as all_customers
    from orders group by 1
    """,
)
def _distinct_by_year(spark, sf_dir):
    """G-2: customer sets stored per month, united per year and over all, counted without the
    facts."""
    o = _t(spark, sf_dir, "orders")
    monthly = bitmaps.key_sets(o, {"year": F.year("o_orderdate"), "month": F.month("o_orderdate")}, "o_custkey")
    yearly = bitmaps.cardinality(bitmaps.unite(monthly, ["year"]), ["year"], "customers")
    every = bitmaps.cardinality(bitmaps.unite(monthly, []), [], "all_customers")
    return yearly.crossJoin(F.broadcast(every))


@register(
    "calendar_range",
    """
    with b as (select cast(min(ts) as date) as lo, cast(max(ts) as date) as hi from events),
    d as (select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as date from b)
    select date, year(date) as year, quarter(date) as quarter, month(date) as month, day(date) as day, dayofweek(date) as day_of_week,
      dayname(date) as day_name, monthname(date) as month_name, week(date) as week_of_year, dayofweek(date) in (0, 6) as is_weekend
    from d
    """,
)
def _calendar_range(spark, sf_dir):
    """D-6: the calendar of the days the events span."""
    lo, hi = _t(spark, sf_dir, "events").agg(F.min("ts").cast("date"), F.max("ts").cast("date")).first()
    return dm.calendar(spark, str(lo), str(hi))


# ---------------------------------------------------------------- warehouse and audit rows of job runs


@register(
    "warehouse_sql",
    """
    select case event_type when 'error' then 'FAILED' when 'signup' then 'WARNING' else 'SUCCESS' end as execution_status, count(*) as runs,
      (select count(*) from events) as row_count, false as healthy, cast(-1 as bigint) as missing
    from events group by 1
    """,
)
def _warehouse_sql(spark, sf_dir):
    """S-13..S-16: events stored as the run log in two commits, then free SQL, row counts and
    the health check (required tables are absent here)."""
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    log = tb.events_as_run_log(_t(spark, sf_dir, "events"))
    full = log.select(*[(F.col(f.name) if f.name in log.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.EXECUTION_LOG.fields])
    wh.append(job.RUNLOG, full.where("execution_id % 2 = 0"))
    wh.append(job.RUNLOG, full.where("execution_id % 2 = 1"))
    again = Warehouse(spark, wh.root)
    counts = again.sql("select execution_status, count(*) as runs from audit_etl_execution_log group by execution_status")
    return counts.select("*", F.lit(again.row_count(job.RUNLOG)).cast("long").alias("row_count"), F.lit(again.health_check()).alias("healthy"),
                         F.lit(again.row_count(job.FACT)).cast("long").alias("missing"))


def _runs(spark, sf_dir) -> str:
    """Both deliveries through the job, then the second again (nothing new)."""
    root = scratch_path(spark, "audit")
    first, second = land_deliveries(spark, sf_dir, f"{root}/landing")
    wh = f"{root}/warehouse"
    job.run(spark, [first], wh, now=NOW1, batch_id="B1", fmt="csv")
    job.run(spark, [second], wh, now=NOW2, batch_id="B2", fmt="csv")
    job.run(spark, [second], wh, now=NOW2, batch_id="B3", fmt="csv")
    return wh


_F = ["transaction_id", "customer_key", "product_key", "time_key", "transaction_amount", "transaction_date"]
_C = ["customer_id", "transaction_id", "transaction_date", "transaction_amount"]


def _suite_sql(batch: str, raw: str, cleaned: str, fact: str) -> str:
    smoke = lambda t, n, src: f"select '{t}', 'SMOKE_COUNT_{n}', cast(count(*) as double), cast(count(*) as double), count(*), 'PASS' from {src}"
    parts = [
        _completeness_sql("fact_transactions", fact, _F), _null_pct_sql("fact_transactions", fact, _F), _dups_sql("fact_transactions", fact, ["transaction_id"]),
        _completeness_sql("cleaned_banking_data", cleaned, _C), _null_pct_sql("cleaned_banking_data", cleaned, _C),
        _dups_sql("cleaned_banking_data", cleaned, ["customer_id", "transaction_id", "transaction_date"]),
        f"select 'fact_transactions', 'SCHEMA_VALIDATION', null, null, count(*), 'PASS' from {fact}",
        "select 'fact_transactions', 'REFERENTIAL_INTEGRITY', 0.0, null, null, 'PASS'",
        smoke("staging.raw_banking_data", "RAW", raw), smoke("staging.cleaned_banking_data", "CLEANED", cleaned), smoke("mart.fact_transactions", "FACT", fact),
    ]
    return f"select '{batch}' as etl_batch_id, table_name, metric_name, cast(metric_value as double) as metric_value, record_count, quality_status from ({' union all '.join(parts)})"


def _audit_sql() -> str:
    from txmart.plans.oracle_sql import two_loads_sql

    return f"with {two_loads_sql()}, both_cleaned as (select * from a_cleaned union all select * from b_cleaned)"


@register(
    "job_metrics",
    f"{_audit_sql()} {_suite_sql('B1', 'raw1', 'a_cleaned', 'm_fact')} union all {_suite_sql('B2', 'raw', 'both_cleaned', 'n_fact')}"
    f" union all {_suite_sql('B3', 'raw', 'both_cleaned', 'n_fact')}",
)
def _job_metrics(spark, sf_dir):
    """S-11, Q-7, Q-8 as stored by three runs; the third finds nothing new and judges the same
    whole tables as the second."""
    return job.read_table(spark, _runs(spark, sf_dir), job.METRICS).select("etl_batch_id", *[c for c in METRIC if c != "metric_percentage"])


@register(
    "job_run_log",
    f"""{_audit_sql()},
    n as (select (select count(*) from raw1) as r1, (select count(*) from raw2) as r2, (select count(*) from a_cleaned) as c1, (select count(*) from b_cleaned) as c2,
            (select count(*) from m_fact) as f1, (select count(*) from n_new_fact) as f2)
    select cast(1 as bigint) as execution_id, 'B1' as etl_batch_id, 'SUCCESS' as execution_status, r1 as rows_extracted, c1 as rows_transformed, f1 as rows_loaded, r1 - c1 as rows_rejected from n
    union all select 2, 'B2', 'SUCCESS', r2, c2, f2, r2 - c2 from n
    union all select 3, 'B3', 'SUCCESS', 0, 0, 0, 0 from n""",
)
def _job_run_log(spark, sf_dir):
    """Q-9 as stored by three runs: read = kept + rejected; the idle one succeeds."""
    return job.read_table(spark, _runs(spark, sf_dir), job.RUNLOG).select(
        "execution_id", "etl_batch_id", "execution_status", "rows_extracted", "rows_transformed", "rows_loaded", "rows_rejected")


@register(
    "reference_members",
    f"""
    with {one_load_sql('B1')},
    p as (select * from (values {", ".join(str(tuple(r)) for r in dm.REFERENCE_PRODUCTS)}) as t(product_id, product_type, product_name, product_category))
    select product_key, product_id, product_type, product_name, product_category from m_dim_products
    union all select (select max(product_key) from m_dim_products) + row_number() over (order by product_id), * from p
      where not exists (select 1 from m_dim_products d where d.product_id = p.product_id)
    """,
)
def _reference_members(spark, sf_dir):
    """D-7: the sample products join the loaded ones, keys after them."""
    m = one_load(spark, sf_dir)
    products, _ = dm.add_reference_members(spark, m.products, m.branches, NOW1)
    return products.select("product_key", "product_id", "product_type", "product_name", "product_category")


# ---------------------------------------------------------------- order, layout, settings, health


def _filled(df, schema):
    """``df`` in the shape of a mart table, absent columns null."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def _days_sql() -> str:
    from txmart.plans.registry import ORACLE_SQL

    return ORACLE_SQL["monthly_trend"].replace("from orders", "from orders where quarter(o_orderdate) = 3 and day(o_orderdate) <= 20")


@register("trend_of_days", _days_sql())
def _trend_of_days(spark, sf_dir):
    """A-3, G-5 over the days picked from the calendar, from facts laid out by month: two
    loads, the second one added when the report is asked for."""
    wh = Warehouse(spark, scratch_path(spark, "month"))
    orders = _t(spark, sf_dir, "orders")
    days = dm.time_rows(orders.select(F.to_date("o_orderdate").alias("date")).distinct())
    wh.append(job.TIME, _filled(days, schemas.DIM_TIME))
    for load in range(2):
        wh.append(job.FACT, _filled(tb.orders_as_fact(orders.where(F.col("o_orderkey") % 2 == load)), schemas.FACT))
        if not load:
            job.FactByMonth(wh).cover()
    return reports.monthly_trend(job.facts_of(spark, wh.root, "quarter = 3 and day <= 20"))


_ORDERED = {  # report -> its key as text, its order
    "customer_summary": ("cast(customer_key as varchar)", "total_amount desc nulls first, customer_key"),
    "monthly_trend": ("cast(month as varchar)", "month desc nulls first"),
    "quality_trend": ("concat(cast(check_date as varchar), ' ', quality_status)", "check_date desc nulls first, quality_status"),
    "run_performance": ("cast(run_date as varchar)", "run_date desc nulls first"),
}


def _order_sql() -> str:
    from txmart.plans.registry import ORACLE_SQL

    return " union all ".join(
        f"select '{name}' as report, row_number() over (order by {order}) as position, {key} as member from ({ORACLE_SQL[name]})"
        for name, (key, order) in _ORDERED.items()
    )


@register("report_order", _order_sql())
def _report_order(spark, sf_dir):
    """L-2: the place of each row in reports that have few rows (top 20, months, days)."""
    orders, events = _t(spark, sf_dir, "orders"), _t(spark, sf_dir, "events")
    built = {
        "customer_summary": reports.customer_summary(tb.customers_as_dim(_t(spark, sf_dir, "customer")), tb.orders_as_fact(orders)),
        "monthly_trend": reports.monthly_trend(tb.orders_as_fact(orders)),
        "quality_trend": reports.quality_trend(tb.events_as_quality_metrics(events), as_of=qr.AS_OF),
        "run_performance": reports.run_performance(tb.events_as_run_log(events), as_of=qr.AS_OF),
    }
    out = None
    for name, rows in built.items():
        member = F.expr(_ORDERED[name][0].replace("varchar", "string"))
        came = rows.select(member.alias("member"), F.monotonically_increasing_id().alias("_at"))  # ids follow the order of rows
        placed = came.select(F.lit(name).alias("report"), F.row_number().over(Window.orderBy("_at")).cast("long").alias("position"), "member")
        out = placed if out is None else out.unionByName(placed)
    return out


_HEALTH = ("staging.raw_banking_data", "staging.cleaned_banking_data", "mart.fact_transactions", "mart.dim_customers", "audit.data_quality_metrics")


@register(
    "health_steps",
    " union all ".join(
        f"select cast({i} as bigint) as step, '{t}' as table_name, count(*) as row_count, {str(i == len(_HEALTH) - 1).lower()} as healthy from {src}"
        for i, (t, src) in enumerate(zip(_HEALTH, ("orders", "orders", "orders", "customer", "events")))
    ),
)
def _health_steps(spark, sf_dir):
    """S-14, S-15: the required tables are stored one by one; the mart is healthy with the last."""
    orders, events = _t(spark, sf_dir, "orders"), _t(spark, sf_dir, "events")
    ids = orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("source_row_id"))
    rows = (ids, ids, tb.orders_as_fact(orders), tb.customers_as_dim(_t(spark, sf_dir, "customer")), tb.events_as_quality_metrics(events))
    wh = Warehouse(spark, scratch_path(spark, "health"))
    seen = []
    for step, (table, df) in enumerate(zip(_HEALTH, rows)):
        wh.append(table, _filled(df, schemas.TABLES[table]))
        again = Warehouse(spark, wh.root)
        seen.append((step, table, again.row_count(table), again.health_check()))
    return spark.createDataFrame(seen, "step long, table_name string, row_count long, healthy boolean")


@register(
    "empty_rows",
    """
    with o as (select o_orderkey as id, case when o_orderkey % 3 <> 0 then cast(o_custkey as varchar) end as customer_id,
      case when o_orderkey % 3 <> 0 and o_orderkey % 2 = 0 then o_orderstatus end as account_type from orders),
    k as (select id, customer_id, account_type, coalesce(account_type, 'UNCLASSIFIED') as product_type, 'UNKNOWN' as account_status, 'GENERAL' as customer_segment from o)
    select 'after defaults' as dropped, * from k union all select 'before defaults', * from k where customer_id is not null or account_type is not null
    """,
)
def _empty_rows(spark, sf_dir):
    """P-6, P-3, P-4: rows of NA tokens alone go when they are looked for before the defaults are
    filled in, and never afterwards."""
    k = F.col("o_orderkey")
    token = F.get(F.array(*[F.lit(t) for t in NA_TOKENS]), (k % len(NA_TOKENS)).cast("int"))
    delivered = _t(spark, sf_dir, "orders").select(
        k.alias("id"), F.when(k % 3 == 0, token).otherwise(F.col("o_custkey").cast("string")).alias(" Customer ID"),
        F.when((k % 3 == 0) | (k % 2 == 1), token).otherwise(F.col("o_orderstatus")).alias("Account Type "),
    )
    cols = ("id", "customer_id", "account_type", "product_type", "account_status", "customer_segment")
    kept = lambda early: conform(delivered, extra=("id",), drop_empty_before_defaults=early).select(
        F.lit("before defaults" if early else "after defaults").alias("dropped"), *cols)
    return kept(False).unionByName(kept(True))


_RUN_SETTINGS = {  # least completeness, most nulls, duplicates checked
    "default": (95.0, 5.0, True), "strict": (100.0, 0.0, False), "lax": (0.0, 100.0, True),
}


def _settings_sql() -> str:
    parts = []
    for name, (full, nulls, dups) in _RUN_SETTINGS.items():
        suite = [_completeness_sql("raw_banking_data", "raw", RAW[1:]).replace(">= 95 ", f">= {full} "),
                 _null_pct_sql("raw_banking_data", "raw", RAW[1:]).replace("<= 5 ", f"<= {nulls} ")]
        if dups:
            suite.append(_dups_sql("raw_banking_data", "raw", ["customer_id", "transaction_id", "transaction_date"]))
        parts.append(f"select '{name}' as settings, * from ({' union all '.join(suite)})")
    return f"with raw as ({fx.F_RAW_SQL}) " + " union all ".join(parts)


@register("run_settings", _settings_sql())
def _run_settings(spark, sf_dir):
    """R-2: limits and switches of the settings decide what the suite says of the same rows."""
    raw = fx.raw_transactions(spark, sf_dir).drop("id")
    out = None
    for name, (full, nulls, dups) in _RUN_SETTINGS.items():
        suite = q.raw_suite(raw, Settings(min_completeness_pct=full, max_null_pct=nulls, duplicate_check_enabled=dups))
        rows = suite.select(F.lit(name).alias("settings"), *METRIC)
        out = rows if out is None else out.unionByName(rows)
    return out
