"""One key holding a third of all rows: results stay whole and exact, and the plans cut
the hot key down before the shuffle (partial limit / partial aggregation)."""

import datetime as dt

from pyspark.sql import functions as F

from txmart.operators import clean as cl
from txmart.operators import quality as q
from txmart.plans import reports

N = 30_000


def skewed(spark):
    # every third row belongs to customer 0; the rest spread over 1..997
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("customer_key"),
        F.format_string("T%d", F.col("id") % (N // 2)).alias("transaction_id"),
        (F.col("id") % 97 + 1).cast("decimal(18,2)").alias("transaction_amount"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 30).cast("int")).alias("transaction_date"),
        F.col("id"),
    )


def test_keep_first_hot_key(spark, capsys):
    df = skewed(spark)
    out = cl.keep_first(df, ["customer_key"], "id")
    got = {r["customer_key"]: r["id"] for r in out.collect()}
    want = {r["customer_key"]: r["m"] for r in df.groupBy("customer_key").agg(F.min("id").alias("m")).collect()}
    assert got == want and got[0] == 0
    out.explain()
    plan = capsys.readouterr().out
    assert plan.index("WindowGroupLimit") < plan.rindex("Exchange hashpartitioning")


def test_duplicates_hot_key(spark, capsys):
    df = skewed(spark)
    m = q.duplicates(df, "t", ["customer_key"]).first()
    assert m["metric_value"] == N and m["record_count"] == N
    q.duplicates(df, "t", ["customer_key"]).explain()
    plan = capsys.readouterr().out
    assert "partial_count" in plan


def test_customer_summary_hot_key(spark):
    df = skewed(spark)
    dims = spark.range(1001).select(
        F.col("id").alias("customer_key"), F.format_string("c%d", "id").alias("customer_name"),
        F.lit("S").alias("customer_segment"), F.lit(True).alias("is_active"),
    )
    rows = reports.customer_summary(dims, df, top=0).collect()
    assert len(rows) == 1001  # whole: nothing dropped
    hot = next(r for r in rows if r["customer_key"] == 0)
    brute = df.where("customer_key = 0").agg(F.count_distinct("transaction_id"), F.sum("transaction_amount")).first()
    assert hot["transaction_count"] == brute[0] and hot["total_amount"] == brute[1]
    assert [r["customer_key"] for r in rows[:3]] == [998, 999, 1000] and rows[0]["total_amount"] is None  # no facts: first
