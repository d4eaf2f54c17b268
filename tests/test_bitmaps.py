"""Bitmap sets of surrogate keys (G-2) against count(distinct), and reports that use them."""

import random

from pyspark.sql import functions as F

from txmart.operators import bitmaps
from txmart.plans import reports


def test_sets_merge_and_count_exactly(spark):
    rng = random.Random(4)
    keys = [0, 1, -1, -40_000, 32_767, 32_768, 32_769, 10**9, None]
    rows = [(f"g{i % 3}", i % 5, rng.choice([*keys, rng.randint(0, 100_000)])) for i in range(4000)] + [("empty", 0, None)]
    df = spark.createDataFrame(rows, "g string, day int, k long")
    daily = bitmaps.key_sets(df, {"g": F.col("g"), "day": F.col("day")}, "k")
    distinct = lambda cols: {tuple(r)[:-1]: r["n"] for r in df.groupBy(*cols).agg(F.count_distinct("k").alias("n")).collect() if r["n"]}
    found = lambda sets, cols: {tuple(r)[:-1]: r["n"] for r in bitmaps.cardinality(sets, cols, "n").collect()}
    assert found(daily, ["g", "day"]) == distinct(["g", "day"])
    assert found(bitmaps.unite(daily, ["g"]), ["g"]) == distinct(["g"])
    assert found(bitmaps.unite(daily, []), []) == distinct([])
    # sets of two loads, stored apart, unite to the set of both
    a, b = (bitmaps.key_sets(df.where(F.col("day") % 2 == p), {"g": F.col("g")}, "k") for p in (0, 1))
    assert found(bitmaps.unite(a.unionByName(b), ["g"]), ["g"]) == distinct(["g"])
    assert found(bitmaps.key_sets(df.limit(0), {}, "k"), []) == {(): 0}


def test_reports_equal_plain_distinct_counts(spark):
    rng = random.Random(6)
    rows = [(rng.choice([1, 2, 3, None]), rng.choice([*range(1, 40), None]), f"T{i}", f"{i % 97}.50", f"2024-{i % 12 + 1:02d}-05") for i in range(500)]
    rows += [(None, 7, "TX", None, None)]
    fact = spark.createDataFrame(rows, "product_key int, customer_key int, transaction_id string, a string, d string").select(
        "product_key", "customer_key", "transaction_id", F.col("a").cast("decimal(18,2)").alias("transaction_amount"), F.col("d").cast("date").alias("transaction_date")
    )
    products = spark.createDataFrame([(k, f"t{k}", f"n{k}", k != 3) for k in (1, 2, 3, 9)], "product_key int, product_type string, product_name string, is_active boolean")
    sums = [F.count_distinct("transaction_id"), F.sum("transaction_amount"), F.avg("transaction_amount"), F.count_distinct("customer_key")]
    want = {r[0]: tuple(r)[1:] for r in fact.groupBy("product_key").agg(*sums).collect()}
    every = fact.agg(F.count_distinct("customer_key")).first()[0]
    got = {r[0]: (r["transaction_count"], r["total_volume"], r["avg_transaction"], r["customer_count"], float(r["customer_penetration_pct"])) for r in reports.product_performance(products, fact).collect()}
    assert set(got) == {1, 2, 9} and got[9] == (0, None, None, 0, 0.0)
    for k in (1, 2):
        n, volume, avg, customers = want[k]
        assert got[k][:2] == (n, volume) and abs(float(got[k][2]) - float(avg)) < 1e-6 and got[k][3:] == (customers, round(customers / every * 100, 2))
    trend = [tuple(r) for r in reports.monthly_trend(fact).collect()]
    by_month = {r[0]: tuple(r)[1:] for r in fact.groupBy(F.trunc("transaction_date", "month")).agg(*sums).collect()}
    assert {t[0]: t[1:] for t in trend} == by_month
    assert [t[0] for t in trend] == sorted(by_month, key=lambda m: (m is not None, m and -m.toordinal()))  # newest first, null before it


def test_no_row_is_copied_for_a_second_distinct_count(spark):
    """Two distinct counts in one aggregate expand every row; bitmaps do not."""
    spark.range(2000).selectExpr("id % 7 as product_key", "id % 90 as customer_key", "cast(id as string) as transaction_id", "cast(id as decimal(18,2)) as transaction_amount",
                                 "date'2024-01-01' as transaction_date").createOrReplaceTempView("f")
    products = spark.range(7).selectExpr("id as product_key", "'t' as product_type", "'n' as product_name", "true as is_active")
    for out in (reports.product_performance(products, spark.table("f")), reports.monthly_trend(spark.table("f"))):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and "bitmap_construct_agg" in plan
    spark.catalog.dropTempView("f")
