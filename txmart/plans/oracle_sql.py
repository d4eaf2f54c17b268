"""DuckDB SQL fragments used by the oracle side of the registered queries.

These restate, in plain SQL over the driver views, what each Spark plan computes; the
driver runs them next to the Spark result at sf0.01.
"""

from __future__ import annotations

from txmart.plans.fixtures import F_DATES_SQL, F_RAW_SQL


def trim_ws(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def title(x: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({x}), '(\\p{{L}}+|\\P{{L}}+)', 1), "
        f"lambda t: upper(t[1]) || t[2:]), '')"
    )


def amount(x: str) -> str:
    return f"abs(try_cast(regexp_replace(cast({x} as varchar), '[^0-9.\\-]', '', 'g') as double))"


ISO, US, EU = "%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y"


def date_mode_cte(name: str, src: str, col: str, order_col: str = "id") -> str:
    """CTE ``name`` with one row/column ``m``: the column-mode format index (-1 generic)."""
    fits = ",\n".join(
        f"coalesce(bool_and({col} is null or try_strptime({col}, '{f}') is not null), true) as f{i}"
        for i, f in enumerate((ISO, US, EU))
    )
    return f"""{name}_s as (select {fits}, arg_min({col}, {order_col}) filter (where {col} is not null) as first_val from {src}),
{name} as (select case when f0 then 0 when f1 then 1 when f2 then 2
    when try_strptime(first_val, '{ISO}') is not null then 0
    when try_strptime(first_val, '{US}') is not null then 1
    when try_strptime(first_val, '{EU}') is not null then 2 else -1 end as m from {name}_s)"""


def parse_by_mode(col: str, mode_col: str) -> str:
    return (
        f"case {mode_col} when 0 then try_strptime({col}, '{ISO}') when 1 then try_strptime({col}, '{US}') "
        f"when 2 then try_strptime({col}, '{EU}') else try_cast({col} as timestamp) end"
    )


def cleaned_ctes(src: str, p: str = "") -> str:
    """CTEs ``{p}dmode .. {p}cleaned``: the cleaned rows (C-1..C-9) of staged rows ``src``."""
    return f"""
{date_mode_cte(p + 'dmode', src, 'transaction_date')},
{p}std as (
  select r.id, r.customer_id, r.transaction_id,
    {parse_by_mode('r.transaction_date', 'dm.m')} as transaction_date,
    {title(trim_ws('r.product_type'))} as product_type,
    {amount('r.transaction_amount')} as amt,
    r.transaction_type, r.account_type, r.account_status,
    {title(trim_ws('r.customer_name'))} as customer_name,
    r.customer_email, r.customer_phone, r.customer_age, r.customer_segment, r.branch_id,
    {title(trim_ws('r.branch_location'))} as branch_location
  from {src} r cross join {p}dmode dm),
{p}tagged as (
  select *, case when transaction_date is null then 'bad_date'
                 when amt is null or amt <= 0 then 'bad_amount'
                 when customer_name is null or branch_location is null or product_type is null then 'missing_text'
                 when customer_id is null or transaction_id is null then 'missing_critical' end as reject_reason
  from {p}std),
{p}survivors as (
  select id, customer_id, transaction_id, transaction_date, product_type,
    cast(amt as decimal(18,2)) as transaction_amount, transaction_type, account_type,
    coalesce(account_status, 'UNKNOWN') as account_status, customer_name, customer_email, customer_phone,
    customer_age, coalesce(customer_segment, 'GENERAL') as customer_segment, branch_id, branch_location,
    row_number() over (partition by customer_id, transaction_id, transaction_date order by id) as rn
  from {p}tagged where reject_reason is null),
{p}cleaned as (
  select id as source_row_id, customer_id, transaction_id, transaction_date, product_type, transaction_amount,
    transaction_type, account_type, account_status, customer_name, customer_email, customer_phone,
    cast(trunc(try_cast(customer_age as double)) as bigint) as customer_age, customer_segment, branch_id, branch_location
  from {p}survivors where rn = 1)"""


# Cleaned rows of F_RAW, as CTEs ending in ``cleaned``.
CLEANED_CTES = f"raw as ({F_RAW_SQL}),\n" + cleaned_ctes("raw")

F_DATES_CTE = f"fdates as ({F_DATES_SQL})"


# ---------------------------------------------------------------- mart (dimensions + fact)

SEED_CTES = """
seed_customers as (select cast(1 as bigint) as customer_key, 'UNKNOWN' as customer_id, 'UNKNOWN' as customer_name,
  cast(null as varchar) as customer_email, cast(null as varchar) as customer_phone, cast(null as bigint) as customer_age,
  'UNKNOWN' as customer_segment, true as is_active),
seed_products as (select cast(1 as bigint) as product_key, 'UNKNOWN' as product_id, 'UNKNOWN' as product_type, 'UNKNOWN' as product_name,
  'UNKNOWN' as product_category, true as is_active),
seed_branches as (select cast(null as bigint) as branch_key, cast(null as varchar) as branch_id, cast(null as varchar) as branch_name,
  cast(null as varchar) as branch_location, true as is_active where false),
seed_time as (select cast(1 as bigint) as time_key, date '1900-01-01' as date, cast(1900 as bigint) as year, cast(1 as bigint) as quarter,
  cast(1 as bigint) as month, cast(1 as bigint) as day, cast(1 as bigint) as day_of_week,
  'Monday' as day_name, 'January' as month_name, cast(1 as bigint) as week_of_year, false as is_weekend),
seed_fact as (select cast(null as bigint) as transaction_key, cast(null as bigint) as customer_key, cast(null as bigint) as product_key,
  cast(null as bigint) as time_key, cast(null as bigint) as branch_key, cast(null as varchar) as transaction_id,
  cast(null as varchar) as account_id, cast(null as decimal(18,2)) as transaction_amount, cast(null as varchar) as transaction_type,
  cast(null as varchar) as account_type, cast(null as varchar) as account_status, cast(null as date) as transaction_date,
  cast(null as varchar) as etl_batch_id where false)"""


def mart_ctes(cleaned: str, p: str, prev: dict, batch_id: str) -> str:
    """CTEs ``{p}dim_customers, {p}dim_products, {p}dim_branches, {p}dim_time, {p}new_fact,
    {p}fact``: one load of ``cleaned`` on top of the tables named in ``prev``."""
    pc, pp, pb, pt, pf = prev["customers"], prev["products"], prev["branches"], prev["time"], prev["fact"]
    attrs = ["customer_name", "customer_email", "customer_phone", "customer_age", "customer_segment"]
    upd = ", ".join(f"case when s.customer_id is not null then s.{a} else t.{a} end as {a}" for a in attrs)
    return f"""
{p}cs as (select * from (select *, row_number() over (partition by customer_id order by source_row_id desc) as rn
   from {cleaned} where customer_id is not null) where rn = 1),
{p}dim_customers as (
  select t.customer_key, t.customer_id, {upd}, t.is_active from {pc} t left join {p}cs s on t.customer_id = s.customer_id
  union all
  select (select coalesce(max(customer_key), 0) from {pc}) + row_number() over (order by s.customer_id),
    s.customer_id, {", ".join("s." + a for a in attrs)}, true
  from {p}cs s where not exists (select 1 from {pc} t where t.customer_id = s.customer_id)),
{p}ps as (select distinct product_type from {cleaned} where product_type is not null),
{p}dim_products as (
  select t.product_key, t.product_id, t.product_type,
    case when s.product_type is not null then s.product_type else t.product_name end as product_name, t.product_category, t.is_active
  from {pp} t left join {p}ps s on t.product_type = s.product_type
  union all
  select (select coalesce(max(product_key), 0) from {pp}) + row_number() over (order by s.product_type),
    s.product_type, s.product_type, s.product_type, 'BANKING', true
  from {p}ps s where not exists (select 1 from {pp} t where t.product_type = s.product_type)),
{p}bs as (select * from (select *, row_number() over (partition by branch_id order by source_row_id desc) as rn
   from {cleaned} where branch_id is not null) where rn = 1),
{p}dim_branches as (
  select t.branch_key, t.branch_id, t.branch_name,
    case when s.branch_id is not null then s.branch_location else t.branch_location end as branch_location, t.is_active
  from {pb} t left join {p}bs s on t.branch_id = s.branch_id
  union all
  select (select coalesce(max(branch_key), 0) from {pb}) + row_number() over (order by s.branch_id),
    s.branch_id, s.branch_id, s.branch_location, true
  from {p}bs s where not exists (select 1 from {pb} t where t.branch_id = s.branch_id)),
{p}ds as (select distinct cast(transaction_date as date) as date from {cleaned} where transaction_date is not null),
{p}dim_time as (
  select * from {pt}
  union all
  select (select coalesce(max(time_key), 0) from {pt}) + row_number() over (order by s.date), s.date,
    year(s.date), quarter(s.date), month(s.date), day(s.date), isodow(s.date), dayname(s.date), monthname(s.date),
    week(s.date), isodow(s.date) in (6, 7)
  from {p}ds s where not exists (select 1 from {pt} t where t.date = s.date)),
{p}res as (
  select c.source_row_id, coalesce(dc.customer_key, 1) as customer_key, coalesce(dp.product_key, 1) as product_key,
    coalesce(dt.time_key, 1) as time_key, db.branch_key, c.transaction_id, c.customer_id as account_id,
    c.transaction_amount, c.transaction_type, c.account_type, c.account_status, cast(c.transaction_date as date) as transaction_date
  from {cleaned} c
  left join {p}dim_customers dc on c.customer_id = dc.customer_id
  left join {p}dim_products dp on c.product_type = dp.product_type
  left join {p}dim_time dt on cast(c.transaction_date as date) = dt.date
  left join {p}dim_branches db on c.branch_id = db.branch_id),
{p}first as (select * from (select *, row_number() over (partition by transaction_id order by source_row_id) as rn from {p}res) x
  where rn = 1 and not exists (select 1 from {pf} f where f.transaction_id = x.transaction_id)),
{p}new_fact as (
  select (select coalesce(max(transaction_key), 0) from {pf}) + row_number() over (order by transaction_id) as transaction_key,
    customer_key, product_key, time_key, branch_key, transaction_id, account_id, transaction_amount, transaction_type,
    account_type, account_status, transaction_date, '{batch_id}' as etl_batch_id
  from {p}first),
{p}fact as (select * from {pf} union all select * from {p}new_fact)"""


FIRST_LOAD = {"customers": "seed_customers", "products": "seed_products", "branches": "seed_branches", "time": "seed_time", "fact": "seed_fact"}


def one_load_sql(batch_id: str) -> str:
    """``with`` body: F_RAW cleaned and loaded once into a seeded mart (prefix ``m_``)."""
    return f"{CLEANED_CTES},{SEED_CTES},{mart_ctes('cleaned', 'm_', FIRST_LOAD, batch_id)}"


def two_loads_sql() -> str:
    """``with`` body: F_RAW delivered in two batches (order dates before 1998, then the
    rest) and loaded twice: first load prefix ``m_``, second ``n_``."""
    second = {"customers": "m_dim_customers", "products": "m_dim_products", "branches": "m_dim_branches",
              "time": "m_dim_time", "fact": "m_fact"}
    return (
        f"raw as ({F_RAW_SQL}),\n"
        "raw1 as (select * from raw where transaction_date < '1998'),\n"
        "raw2 as (select * from raw where not coalesce(transaction_date < '1998', false)),"
        + cleaned_ctes("raw1", "a_") + "," + cleaned_ctes("raw2", "b_") + "," + SEED_CTES + ","
        + mart_ctes("a_cleaned", "m_", FIRST_LOAD, "B1") + "," + mart_ctes("b_cleaned", "n_", second, "B2")
    )


def r2(x: str, places: int = 2) -> str:
    """``round`` with Spark/Python semantics on doubles (half-up of the exact binary
    value): DuckDB's double ``round`` rounds the scaled product instead."""
    return f"cast(round(cast({x} as decimal(38,18)), {places}) as double)"


def avg6(x: str) -> str:
    """Exact half-up average of a positive ``decimal(18,2)`` at scale 6, as Spark's decimal
    ``avg`` gives it (DuckDB's ``avg`` of a decimal is a double)."""
    n = f"count({x})"
    return f"(cast((cast(sum({x}) * 100 as hugeint) * 20000 + {n}) // (2 * {n}) as double) / 1000000)"
