"""The staged rows that Spark derives from the tables."""

import datetime as dt

from pyspark.sql import functions as F

from txmart.plans import fixtures as fx


def test_orders_are_scanned_once_and_dealt_to_many_tasks(spark, tmp_root):
    """Keys that repeat or are null, customers from which a re-send cannot move down, odd years."""
    day = dt.date(1996, 1, 2)
    rows = [(k, c, 10.0, day, "1-URGENT", "O") for k in (0, 1, 20, 50, 100, 100, 150, None) for c in (-1, 0, 7, None)]
    schema = "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate date, o_orderpriority string, o_orderstatus string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_root}/orders.parquet")
    orders = spark.read.parquet(f"{tmp_root}/orders.parquet")
    got = fx._orders_with_resends(orders)
    want = [(k, k, c) for k, c, *_ in rows]
    want += [(k + 10_000_000, k, c) for k, c, *_ in rows if k is not None and k % 20 == 0]
    want += [(k + 20_000_000, k, c - 1 if c is not None and c > 0 else 1) for k, c, *_ in rows if k is not None and k % 50 == 0]
    order = lambda r: [(x is None, x or 0) for x in r]
    assert sorted((tuple(r) for r in got.select("id", "o_orderkey", "o_custkey").collect()), key=order) == sorted(want, key=order)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Exchange hashpartitioning" in plan


def test_date_text_of_any_year(spark):
    dates = ["1996-01-02", "1000-12-31", "0999-02-03", "0001-01-01", "9999-12-31"]
    out = spark.createDataFrame([(d,) for d in dates], "d string").select(fx.iso_date_text(F.col("d").cast("date")), fx.iso_date_text(F.col("d").cast("timestamp")))
    want = ["1996-01-02", "1000-12-31", "999-02-03", "1-01-01", "9999-12-31"]
    assert [tuple(r) for r in out.collect()] == [(w, w) for w in want]
