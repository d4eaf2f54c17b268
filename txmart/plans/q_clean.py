"""Registered conform/clean queries (P-*, S-2, S-5, C-*) over rows derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from txmart.operators import clean as cl
from txmart.operators import conform as cf
from txmart.operators.fact import take_unprocessed
from txmart.plans import fixtures as fx
from txmart.plans.oracle_sql import CLEANED_CTES, F_DATES_CTE, amount, date_mode_cte, parse_by_mode, title, trim_ws
from txmart.plans.registry import _t, register
from txmart.settings import CANONICAL_COLUMNS
from txmart.sources.staging import raw_payload

# ---------------------------------------------------------------- conform

_SOURCE_SQL = """
src as (
  select concat('C', cast(o.o_custkey as varchar)) as customer_id,
    concat('T', cast(o.o_orderkey as varchar)) as transaction_id,
    concat(cast(year(o.o_orderdate) as varchar), '-', lpad(cast(month(o.o_orderdate) as varchar), 2, '0'), '-', lpad(cast(day(o.o_orderdate) as varchar), 2, '0')) as transaction_date,
    concat('$', cast(cast(o.o_totalprice as decimal(18,2)) as varchar)) as transaction_amount,
    case when o.o_orderkey % 2 = 0 then 'Deposit' else 'Withdrawal' end as transaction_type,
    case when o.o_orderkey % 3 = 0 then null else o.o_orderpriority end as account_type,
    case when o.o_orderkey % 6 = 0 then null when o.o_orderkey % 3 = 0 then 'Personal Loan' end as loan_type,
    case when o.o_orderkey % 3 = 0 then 'Gold Card' end as card_type,
    concat('c', cast(c.c_custkey as varchar), '@example.com') as customer_email,
    case when o.o_orderkey % 7 = 0 then null else concat('555-', lpad(cast(o.o_orderkey % 10000 as varchar), 4, '0')) end as customer_phone,
    cast(c.c_custkey % 60 + 18 as varchar) as customer_age,
    concat('BRN', lpad(cast(n.n_nationkey as varchar), 3, '0')) as branch_id,
    n.n_name as branch_location,
    o.o_orderstatus as account_status,
    concat(chr(9), split_part(c.c_name, '#', 1), ' ') as first_name,
    case when o.o_orderkey % 4 = 0 then null else split_part(c.c_name, '#', 2) end as last_name
  from orders o join customer c on o.o_custkey = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey)
"""


@register(
    "conform_columns",
    f"""
    with {_SOURCE_SQL}
    select customer_id, transaction_id, transaction_date,
      coalesce(account_type, loan_type, card_type, 'UNCLASSIFIED') as product_type,
      transaction_amount, transaction_type, account_type, account_status,
      {trim_ws(f"concat({trim_ws('coalesce(first_name, ' + chr(39) * 2 + ')')}, ' ', {trim_ws('coalesce(last_name, ' + chr(39) * 2 + ')')})")} as customer_name,
      customer_email, customer_phone, customer_age, 'GENERAL' as customer_segment, branch_id, branch_location
    from src
    """,
)
def _conform_columns(spark, sf_dir):
    """P-1..P-6 + S-2: a file with human headers conformed to the 15 canonical columns."""
    return cf.conform(fx.source_rows(spark, sf_dir))


# ---------------------------------------------------------------- dates


@register(
    "clean_dates_column",
    f"""
    with {F_DATES_CTE},
    {date_mode_cte('mus', 'fdates', 'd_us')},
    {date_mode_cte('meu', 'fdates', 'd_eu')},
    {date_mode_cte('mmx', 'fdates', 'd_mixed')}
    select f.id, {parse_by_mode('f.d_us', 'mus.m')} as d_us, {parse_by_mode('f.d_eu', 'meu.m')} as d_eu,
      {parse_by_mode('f.d_mixed', 'mmx.m')} as d_mixed
    from fdates f cross join mus cross join meu cross join mmx
    """,
)
def _clean_dates_column(spark, sf_dir):
    """C-1/C-2: column-mode parse of US, EU and mixed columns (mixed falls back to the
    first value's format, so only rows in that format parse)."""
    return cl.parse_dates(fx.date_columns(spark, sf_dir), ("d_us", "d_eu", "d_mixed"), mode="column", order_col="id")


@register(
    "clean_dates_row",
    """
    with fdates as ({fd})
    select id, coalesce(try_strptime(d_mixed, '%Y-%m-%d'), try_strptime(d_mixed, '%m/%d/%Y'), try_strptime(d_mixed, '%d/%m/%Y')) as d_mixed
    from fdates
    """.replace("{fd}", fx.F_DATES_SQL),
)
def _clean_dates_row(spark, sf_dir):
    """C-1 row mode: each value takes the first format that parses it."""
    return cl.parse_dates(fx.date_columns(spark, sf_dir).select("id", "d_mixed"), "d_mixed", mode="row")


@register(
    "clean_dates_fallback",
    f"""
    with raw as ({fx.F_RAW_SQL}), {date_mode_cte('dm', 'raw', 'transaction_date')}
    select r.id, {parse_by_mode('r.transaction_date', 'dm.m')} as transaction_date
    from raw r cross join dm
    where {parse_by_mode('r.transaction_date', 'dm.m')} is not null
    """,
)
def _clean_dates_fallback(spark, sf_dir):
    """C-1/C-2 on F_RAW: one bad value defeats every format; the fallback parses by the
    first value's format and drops what does not parse."""
    return cl.clean_dates(fx.raw_transactions(spark, sf_dir).select("id", "transaction_date"))


# ---------------------------------------------------------------- amounts, text, age, missing


@register(
    "clean_amounts",
    f"""
    with raw as ({fx.F_RAW_SQL})
    select id, cast(cast({amount('transaction_amount')} as decimal(18,2)) as double) as transaction_amount
    from raw where {amount('transaction_amount')} > 0
    """,
)
def _clean_amounts(spark, sf_dir):
    """C-3: digits/dot/minus only, numeric-or-null, absolute, > 0, decimal(18,2)."""
    return cl.clean_amounts(fx.raw_transactions(spark, sf_dir).select("id", "transaction_amount"))


@register(
    "clean_text",
    f"""
    with raw as ({fx.F_RAW_SQL}),
    t as (select id, {title(trim_ws('customer_name'))} as customer_name, {title(trim_ws('branch_location'))} as branch_location,
                 {title(trim_ws('product_type'))} as product_type from raw)
    select * from t where customer_name is not null and branch_location is not null and product_type is not null
    """,
)
def _clean_text(spark, sf_dir):
    """C-4: strip + Python-style title case of name, branch and product; nulls drop the row."""
    return cl.clean_text(fx.raw_transactions(spark, sf_dir).select("id", "customer_name", "branch_location", "product_type"))


@register(
    "clean_age",
    f"""
    with raw as ({fx.F_RAW_SQL})
    select id, customer_age as age_text, cast(trunc(try_cast(customer_age as double)) as bigint) as customer_age from raw
    """,
)
def _clean_age(spark, sf_dir):
    """C-9: numeric-or-null age truncated to int."""
    df = fx.raw_transactions(spark, sf_dir).select("id", F.col("customer_age").alias("age_text"), "customer_age")
    return cl.clean_age(df)


@register(
    "drop_critical",
    f"""
    with raw as ({fx.F_RAW_SQL})
    select id, customer_id, transaction_id, transaction_date, transaction_amount from raw
    where customer_id is not null and transaction_id is not null and transaction_date is not null and transaction_amount is not null
    """,
)
def _drop_critical(spark, sf_dir):
    """C-5: rows lacking any critical column are dropped."""
    raw = fx.raw_transactions(spark, sf_dir).select("id", "customer_id", "transaction_id", "transaction_date", "transaction_amount")
    return cl.drop_critical(raw)


@register(
    "fill_defaults",
    f"""
    with raw as ({fx.F_RAW_SQL})
    select id, coalesce(account_status, 'UNKNOWN') as account_status, coalesce(product_type, 'UNCLASSIFIED') as product_type,
      coalesce(customer_segment, 'GENERAL') as customer_segment from raw
    """,
)
def _fill_defaults(spark, sf_dir):
    """C-6: status/product/segment defaults."""
    return cl.fill_defaults(fx.raw_transactions(spark, sf_dir).select("id", "account_status", "product_type", "customer_segment"))


@register(
    "missing_profile",
    f"""
    with raw as ({fx.F_RAW_SQL})
    select column_name, null_count, row_count from (
      select count(*) as row_count,
        {", ".join(f"count(*) - count({c}) as {c}" for c in ("id", "customer_id", "transaction_id", "transaction_date", "product_type", "transaction_amount", "transaction_type", "account_type", "account_status", "customer_name", "customer_email", "customer_phone", "customer_age", "customer_segment", "branch_id", "branch_location"))}
      from raw) unpivot (null_count for column_name in ({", ".join(("id", "customer_id", "transaction_id", "transaction_date", "product_type", "transaction_amount", "transaction_type", "account_type", "account_status", "customer_name", "customer_email", "customer_phone", "customer_age", "customer_segment", "branch_id", "branch_location"))}))
    """,
)
def _missing_profile(spark, sf_dir):
    """S-5/C-7: null count per column of the staged batch."""
    return cl.missing_profile(fx.raw_transactions(spark, sf_dir))


# ---------------------------------------------------------------- dedupe, whole clean, accounting


@register("cleaned_rows", f"with {CLEANED_CTES} select * replace (cast(transaction_amount as double) as transaction_amount) from cleaned")
def _cleaned_rows(spark, sf_dir):
    """C-1..C-9 composed: the cleaned batch."""
    return cl.clean_transactions(fx.raw_transactions(spark, sf_dir))


@register(
    "dedupe_first",
    f"""
    with {CLEANED_CTES}
    select source_row_id, customer_id, transaction_id, transaction_date from cleaned
    """,
)
def _dedupe_first(spark, sf_dir):
    """C-8 on the cleaned batch: first row by staging id per (customer, transaction, date)."""
    return cl.clean_transactions(fx.raw_transactions(spark, sf_dir)).select(
        "source_row_id", "customer_id", "transaction_id", "transaction_date"
    )


_LINEITEM_COLS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)


@register(
    "dedupe_first_lineitem",
    f"""
    select {", ".join(c if c != "l_linenumber" else "cast(l_linenumber as bigint) as l_linenumber" for c in _LINEITEM_COLS)} from (
      select *, row_number() over (partition by l_orderkey, l_linenumber
        order by {", ".join(_LINEITEM_COLS[2:])}) as rn from lineitem) where rn = 1
    """,
)
def _dedupe_first_lineitem(spark, sf_dir):
    """C-8 on lineitem: (l_orderkey, l_linenumber) repeats; keep the first by all other columns."""
    li = _t(spark, sf_dir, "lineitem").select(*_LINEITEM_COLS)
    return cl.keep_first(li, ["l_orderkey", "l_linenumber"], list(_LINEITEM_COLS[2:]))


@register(
    "reject_counts",
    f"""
    with {CLEANED_CTES},
    g as (select customer_id, transaction_id, transaction_date, count(*) as n from tagged where reject_reason is null
          group by customer_id, transaction_id, transaction_date)
    select (select count(*) from tagged) as rows_read,
      (select count(*) from tagged where reject_reason = 'bad_date') as rejected_bad_date,
      (select count(*) from tagged where reject_reason = 'bad_amount') as rejected_bad_amount,
      (select count(*) from tagged where reject_reason = 'missing_text') as rejected_missing_text,
      (select count(*) from tagged where reject_reason = 'missing_critical') as rejected_missing_critical,
      (select count(*) from g) as rows_kept,
      (select cast(coalesce(sum(n - 1), 0) as bigint) from g) as rejected_duplicate,
      (select count(*) from tagged) - (select count(*) from g) as rows_rejected
    """,
)
def _reject_counts(spark, sf_dir):
    """C-10: rows read = kept + rejected, with the reason of every rejection."""
    return cl.reject_counts(fx.raw_transactions(spark, sf_dir))


# ---------------------------------------------------------------- staging payload, scans, samples

_JSON_SQL = "cast(to_json({" + ", ".join(f"'{c}': {c}" for c in CANONICAL_COLUMNS) + "}) as varchar)"


@register("raw_json", f"with raw as ({fx.F_RAW_SQL}) select id, {_JSON_SQL} as raw_data from raw")
def _raw_json(spark, sf_dir):
    """S-6: each staged row as JSON text with nulls kept."""
    return fx.raw_transactions(spark, sf_dir).select("id", raw_payload(CANONICAL_COLUMNS).alias("raw_data"))


@register("row_md5", f"with raw as ({fx.F_RAW_SQL}) select id, md5({_JSON_SQL}) as row_md5 from raw")
def _row_md5(spark, sf_dir):
    """§2.9 MD5 hex of each row's JSON payload."""
    return fx.raw_transactions(spark, sf_dir).select("id", F.md5(raw_payload(CANONICAL_COLUMNS)).alias("row_md5"))


@register(
    "unprocessed_scan",
    f"""
    with raw as ({fx.F_RAW_SQL})
    select id, customer_id, transaction_id, transaction_date from raw
    where not coalesce(transaction_date < '1998', false)
    """,
)
def _unprocessed_scan(spark, sf_dir):
    """S-7: after the first delivery (order dates before 1998) was processed, the scan
    returns the rows not yet processed."""
    raw = fx.raw_transactions(spark, sf_dir)
    staged = raw.withColumn("is_processed", F.coalesce(F.col("transaction_date") < "1998", F.lit(False)))
    batch, _ = take_unprocessed(staged)
    return batch.select("id", "customer_id", "transaction_id", "transaction_date")


@register(
    "recent_sample",
    """
    select event_id, ts, event_type from events order by ts desc, event_id desc limit 50000
    """,
)
def _recent_sample(spark, sf_dir):
    """S-12: the newest 50,000 rows by time (the source's quality sample; a top-k)."""
    ev = _t(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return ev.orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(50_000)
