"""Dirty transaction rows that Spark derives from the given tables.

``raw_transactions`` is the F_RAW staging batch of FIXTURES.md: every order becomes a
transaction, every 20th is re-sent unchanged and every 50th re-sent for another customer,
with bad dates, amounts, nulls and padding injected by rule. ``source_rows`` is the same
shape before conforming: human headers as a delivered file has them. ``date_columns`` is
F_DATES. All are whole-table projections/joins, so they grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txmart.sources.tables import read_table


def _s(c: Column) -> Column:
    return c.cast("string")


def iso_date_text(d: Column) -> Column:
    parts = F.concat(_s(F.year(d)), F.lit("-"), F.lpad(_s(F.month(d)), 2, "0"), F.lit("-"), F.lpad(_s(F.dayofmonth(d)), 2, "0"))
    day = d.cast("date")  # its text is the same, and cheaper, for years of four digits
    return F.when(F.year(day).between(1000, 9999), _s(day)).otherwise(parts)


def _orders_with_resends(orders: DataFrame) -> DataFrame:
    """Every order and its re-sends, from one scan. The rows are dealt out anew first: building
    their texts costs far more than reading them, and a file may be read by few tasks."""
    o = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus")
    o = o.repartition("o_orderkey", "o_custkey", "o_totalprice")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    sent = lambda key, customer: F.struct(key.alias("id"), customer.alias("o_custkey"))
    base, resent = sent(k, c), sent(k + 10_000_000, c)
    moved = sent(k + 20_000_000, F.when(c > 0, c - 1).otherwise(F.lit(1)))
    again, elsewhere = k % 20 == 0, k % 50 == 0
    each = (
        F.when(again & elsewhere, F.array(base, resent, moved)).when(again, F.array(base, resent))
        .when(elsewhere, F.array(base, moved)).otherwise(F.array(base))
    )
    return o.select(F.inline(each).alias("id", "o_custkey"), "o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus")


def raw_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the texts of F_RAW are made of: ``id`` and columns of the tables, a fraction of their width."""
    s = _orders_with_resends(read_table(spark, sf_dir, "orders"))
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return s.join(c, s.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))


def raw_columns() -> list[Column]:
    """``id`` + the 15 canonical string columns, over :func:`raw_inputs`."""
    k, ck = F.col("o_orderkey"), F.col("c_custkey")
    money = _s(F.col("o_totalprice").cast("decimal(18,2)"))
    return [
        "id",
        F.concat(F.lit("C"), _s(F.col("o_custkey"))).alias("customer_id"),
        F.when(k % 97 == 0, F.lit(None)).otherwise(F.concat(F.lit("T"), _s(k))).alias("transaction_id"),
        raw_date().alias("transaction_date"),
        F.when(k % 83 == 0, F.lit(None)).otherwise(F.concat(F.lit("  "), F.lower("o_orderpriority"), F.lit(" "))).alias("product_type"),
        F.when(k % 79 == 0, F.lit("N/A"))
        .when(k % 73 == 0, F.lit("$0.00"))
        .when(k % 5 == 0, F.concat(F.lit("-"), money))
        .otherwise(F.concat(F.lit("$"), money))
        .alias("transaction_amount"),
        F.when(k % 2 == 0, F.lit("Deposit")).otherwise(F.lit("Withdrawal")).alias("transaction_type"),
        F.col("o_orderpriority").alias("account_type"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("account_status"),
        F.concat(F.lit(" "), F.lower("c_name"), F.lit(" ")).alias("customer_name"),
        F.concat(F.lit("c"), _s(ck), F.lit("@example.com")).alias("customer_email"),
        F.lit(None).cast("string").alias("customer_phone"),
        F.when(ck % 13 == 0, F.lit("unknown")).otherwise(F.concat(_s(ck % 60 + 18), F.lit(".7"))).alias("customer_age"),
        F.when(ck % 17 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("customer_segment"),
        F.when(k % 71 == 0, F.lit(None)).otherwise(F.concat(F.lit("BRN"), F.lpad(_s(F.col("n_nationkey")), 3, "0"))).alias("branch_id"),
        F.lower("n_name").alias("branch_location"),
    ]


def raw_date() -> Column:
    """The date text of F_RAW."""
    return F.when(F.col("o_orderkey") % 89 == 0, F.lit("not-a-date")).otherwise(iso_date_text(F.col("o_orderdate")))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F_RAW: ``id`` + the 15 canonical string columns."""
    return raw_inputs(spark, sf_dir).select(*raw_columns())


F_RAW_SQL = """
with src as (
  select o_orderkey as id, o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus from orders
  union all
  select o_orderkey + 10000000, o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus
  from orders where o_orderkey % 20 = 0
  union all
  select o_orderkey + 20000000, o_orderkey, case when o_custkey > 0 then o_custkey - 1 else 1 end, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus
  from orders where o_orderkey % 50 = 0
)
select s.id,
  concat('C', cast(s.o_custkey as varchar)) as customer_id,
  case when s.o_orderkey % 97 = 0 then null else concat('T', cast(s.o_orderkey as varchar)) end as transaction_id,
  case when s.o_orderkey % 89 = 0 then 'not-a-date'
       else concat(cast(year(s.o_orderdate) as varchar), '-', lpad(cast(month(s.o_orderdate) as varchar), 2, '0'), '-', lpad(cast(day(s.o_orderdate) as varchar), 2, '0')) end as transaction_date,
  case when s.o_orderkey % 83 = 0 then null else concat('  ', lower(s.o_orderpriority), ' ') end as product_type,
  case when s.o_orderkey % 79 = 0 then 'N/A'
       when s.o_orderkey % 73 = 0 then '$0.00'
       when s.o_orderkey % 5 = 0 then concat('-', cast(cast(s.o_totalprice as decimal(18,2)) as varchar))
       else concat('$', cast(cast(s.o_totalprice as decimal(18,2)) as varchar)) end as transaction_amount,
  case when s.o_orderkey % 2 = 0 then 'Deposit' else 'Withdrawal' end as transaction_type,
  s.o_orderpriority as account_type,
  case when s.o_orderkey % 11 = 0 then null else s.o_orderstatus end as account_status,
  concat(' ', lower(c.c_name), ' ') as customer_name,
  concat('c', cast(c.c_custkey as varchar), '@example.com') as customer_email,
  cast(null as varchar) as customer_phone,
  case when c.c_custkey % 13 = 0 then 'unknown' else concat(cast(18 + c.c_custkey % 60 as varchar), '.7') end as customer_age,
  case when c.c_custkey % 17 = 0 then null else c.c_mktsegment end as customer_segment,
  case when s.o_orderkey % 71 = 0 then null else concat('BRN', lpad(cast(n.n_nationkey as varchar), 3, '0')) end as branch_id,
  lower(n.n_name) as branch_location
from src s join customer c on s.o_custkey = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey
"""


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a delivered file has them: human headers (some padded), first/last
    name, no product column (account/loan/card type instead), NA tokens as text."""
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("o_orderkey")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    name_parts = F.split(F.col("c_name"), "#")
    return j.select(
        F.concat(F.lit("C"), _s(F.col("o_custkey"))).alias(" Customer ID "),
        F.concat(F.lit("T"), _s(k)).alias("TransactionID"),
        iso_date_text(F.col("o_orderdate")).alias("Transaction Date"),
        F.concat(F.lit("$"), _s(F.col("o_totalprice").cast("decimal(18,2)"))).alias("Transaction Amount"),
        F.when(k % 2 == 0, F.lit("Deposit")).otherwise(F.lit("Withdrawal")).alias("Transaction Type"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("Account Type"),
        F.when(k % 6 == 0, F.lit("N/A")).when(k % 3 == 0, F.lit("Personal Loan")).alias("Loan Type"),
        F.when(k % 3 == 0, F.lit("Gold Card")).alias("Card Type"),
        F.concat(F.lit("c"), _s(F.col("c_custkey")), F.lit("@example.com")).alias("Email"),
        F.when(k % 7 == 0, F.lit("NULL")).otherwise(F.concat(F.lit("555-"), F.lpad(_s(k % 10000), 4, "0"))).alias("Contact Number"),
        _s(F.col("c_custkey") % 60 + 18).alias("Age"),
        F.concat(F.lit("BRN"), F.lpad(_s(F.col("n_nationkey")), 3, "0")).alias("Branch ID"),
        F.col("n_name").alias("City"),
        F.col("o_orderstatus").alias("Loan Status"),
        F.concat(F.lit("\t"), name_parts[0], F.lit(" ")).alias("First Name"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(name_parts[1]).alias("Last Name "),
    )


def date_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F_DATES: one order date as US, EU and mixed-format text."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    d = F.col("o_orderdate")
    y, m, dd = _s(F.year(d)), F.lpad(_s(F.month(d)), 2, "0"), F.lpad(_s(F.dayofmonth(d)), 2, "0")
    us = F.concat(m, F.lit("/"), dd, F.lit("/"), y)
    eu = F.concat(dd, F.lit("/"), m, F.lit("/"), y)
    k = F.col("o_orderkey")
    return o.select(
        k.alias("id"),
        us.alias("d_us"),
        eu.alias("d_eu"),
        F.when(k % 3 == 0, iso_date_text(d)).when(k % 3 == 1, us).otherwise(eu).alias("d_mixed"),
    )


F_DATES_SQL = """
select o_orderkey as id,
  concat(lpad(cast(month(o_orderdate) as varchar), 2, '0'), '/', lpad(cast(day(o_orderdate) as varchar), 2, '0'), '/', cast(year(o_orderdate) as varchar)) as d_us,
  concat(lpad(cast(day(o_orderdate) as varchar), 2, '0'), '/', lpad(cast(month(o_orderdate) as varchar), 2, '0'), '/', cast(year(o_orderdate) as varchar)) as d_eu,
  case when o_orderkey % 3 = 0 then concat(cast(year(o_orderdate) as varchar), '-', lpad(cast(month(o_orderdate) as varchar), 2, '0'), '-', lpad(cast(day(o_orderdate) as varchar), 2, '0'))
       when o_orderkey % 3 = 1 then concat(lpad(cast(month(o_orderdate) as varchar), 2, '0'), '/', lpad(cast(day(o_orderdate) as varchar), 2, '0'), '/', cast(year(o_orderdate) as varchar))
       else concat(lpad(cast(day(o_orderdate) as varchar), 2, '0'), '/', lpad(cast(month(o_orderdate) as varchar), 2, '0'), '/', cast(year(o_orderdate) as varchar)) end as d_mixed
from orders
"""
