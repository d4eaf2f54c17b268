import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from txmart import schemas
from txmart.operators import dims
from txmart.operators import fact as fc
from txmart.operators.keys import assign_keys
from txmart.operators.merge import ConflictingSourceRows, insert_if_absent, upsert

NOW = dt.datetime(2024, 2, 1)


def test_assign_keys_dense_ordered_and_continuing(spark):
    df = spark.range(0, 5000, 1, 7).select(F.format_string("K%05d", (F.col("id") * 7919) % 5000).alias("k"))
    keyed = assign_keys(df, "key", ["k"], base=10, num_partitions=5)
    want = df.select("k", (F.row_number().over(Window.orderBy("k")) + 10).alias("want"))
    rows = keyed.join(want, "k").collect()
    assert len(rows) == 5000 and all(r["key"] == r["want"] for r in rows)


def test_assign_keys_plan_has_no_single_partition_sort_of_rows(spark, capsys):
    df = spark.range(100000).select((F.col("id") * 13 % 100000).alias("k"))
    assign_keys(df, "key", ["k"]).explain()
    plan = capsys.readouterr().out
    # the only single-partition exchange is over the per-partition counts (one row per partition)
    assert plan.count("SinglePartition") <= 1


def dim_customers(spark, rows):
    return spark.createDataFrame(
        [(k, cid, name, None, None, None, seg, True, NOW, NOW) for k, cid, name, seg in rows], schemas.DIM_CUSTOMERS
    )


def test_upsert_latest_wins_inserts_and_keeps_unlisted(spark):
    target = dim_customers(spark, [(1, "UNKNOWN", "UNKNOWN", "UNKNOWN"), (2, "C1", "Old", "A")])
    target = target.withColumn("is_active", F.when(F.col("customer_id") == "C1", False).otherwise(True))
    src = spark.createDataFrame(
        [(10, "C1", "First", "B"), (11, "C1", "Second", "C"), (12, "C9", "New", "D")],
        "source_row_id long, customer_id string, customer_name string, customer_segment string",
    )
    later = dt.datetime(2024, 3, 1)
    out = upsert(target, src, "customer_id", "customer_key", ["customer_name", "customer_segment"],
                 {"customer_id": F.col("customer_id"), "customer_name": F.col("customer_name"),
                  "customer_segment": F.col("customer_segment"), "is_active": F.lit(True)}, now=later)
    got = {r["customer_id"]: r for r in out.collect()}
    assert got["C1"]["customer_key"] == 2 and got["C1"]["customer_name"] == "Second" and got["C1"]["customer_segment"] == "C"
    assert got["C1"]["is_active"] is False  # unlisted column kept
    assert got["C1"]["created_at"] == NOW and got["C1"]["updated_at"] == later
    assert got["C9"]["customer_key"] == 3 and got["C9"]["created_at"] == later
    assert got["UNKNOWN"]["updated_at"] == NOW
    with pytest.raises(ConflictingSourceRows):
        upsert(target, src, "customer_id", "customer_key", ["customer_name"],
               {"customer_id": F.col("customer_id"), "customer_name": F.col("customer_name")}, on_conflicting="error")


def test_insert_if_absent_keeps_existing(spark):
    t = dims.seed_time(spark)
    dates = spark.createDataFrame([(dt.date(1900, 1, 1),), (dt.date(2024, 1, 6),), (dt.date(2024, 1, 6),)], "date date")
    out = insert_if_absent(t, dims.time_rows(dates), "date", "time_key").orderBy("time_key").collect()
    assert [(r["time_key"], r["date"], r["is_weekend"]) for r in out] == [
        (1, dt.date(1900, 1, 1), False), (2, dt.date(2024, 1, 6), True)]


def test_branches_start_at_one_and_products_after_unknown(spark):
    cleaned = spark.createDataFrame(
        [(1, "B2", "Loc", "Savings"), (2, "B1", "Loc1", "Loan")],
        "source_row_id long, branch_id string, branch_location string, product_type string",
    )
    b = dims.merge_branches(dims.seed_branches(spark), cleaned).orderBy("branch_key").collect()
    assert [(r["branch_key"], r["branch_id"], r["branch_name"]) for r in b] == [(1, "B1", "B1"), (2, "B2", "B2")]
    p = dims.merge_products(dims.seed_products(spark), cleaned).orderBy("product_key").collect()
    assert [(r["product_key"], r["product_id"], r["product_category"]) for r in p] == [
        (1, "UNKNOWN", "UNKNOWN"), (2, "Loan", "BANKING"), (3, "Savings", "BANKING")]


def test_reference_members_inserted_once(spark):
    p, b = dims.add_reference_members(spark, dims.seed_products(spark), dims.seed_branches(spark), now=NOW)
    p2, b2 = dims.add_reference_members(spark, p, b, now=NOW)
    assert p.count() == 9 and b.count() == 6 and p2.count() == 9 and b2.count() == 6
    assert dims.calendar(spark).count() == 366


def cleaned_rows(spark, rows):
    schema = ("source_row_id long, customer_id string, transaction_id string, transaction_date timestamp_ntz, "
              "product_type string, transaction_amount decimal(18,2), transaction_type string, account_type string, "
              "account_status string, branch_id string")
    return spark.createDataFrame(rows, schema)


def test_fact_unknown_members_first_wins_and_existing_skipped(spark):
    from decimal import Decimal as D
    d = dt.datetime(2024, 1, 5)
    cleaned = cleaned_rows(spark, [
        (1, "C1", "T1", d, "Savings", D("10.00"), "Deposit", "A", "OPEN", "B1"),
        (2, "CX", "T2", d, "Nope", D("20.00"), "Deposit", "A", "OPEN", "BX"),
        (3, "C1", "T1", d, "Savings", D("30.00"), "Deposit", "A", "OPEN", "B1"),
        (4, "C1", "T0", d, "Savings", D("40.00"), "Deposit", "A", "OPEN", "B1"),
    ])
    cust = dim_customers(spark, [(1, "UNKNOWN", "UNKNOWN", "UNKNOWN"), (2, "C1", "A", "S")])
    prod = dims.merge_products(dims.seed_products(spark), cleaned.where("product_type = 'Savings'"))
    bran = dims.merge_branches(dims.seed_branches(spark), cleaned.where("branch_id = 'B1'").withColumn("branch_location", F.lit("L")))
    time = dims.merge_time(dims.seed_time(spark), cleaned)
    existing = spark.createDataFrame([], schemas.FACT)
    existing = existing.unionByName(fc.new_facts(cleaned.where("transaction_id = 'T0'"), cust, prod, time, bran, existing, "B0", NOW))
    out = {r["transaction_id"]: r for r in fc.new_facts(cleaned, cust, prod, time, bran, existing, "B1", NOW).collect()}
    assert sorted(out) == ["T1", "T2"]
    assert float(out["T1"]["transaction_amount"]) == 10.0  # lowest source row wins
    assert (out["T2"]["customer_key"], out["T2"]["product_key"], out["T2"]["branch_key"]) == (1, 1, None)
    assert out["T2"]["time_key"] == 2 and out["T1"]["branch_key"] == 1
    assert sorted(r["transaction_key"] for r in out.values()) == [2, 3]  # after the existing key 1


def test_watermark_flags(spark):
    marks = spark.createDataFrame([("B1", 3, 3, NOW), ("B2", 5, 5, dt.datetime(2024, 2, 2))], schemas.RUN_MARKS)
    raw = spark.range(1, 8).withColumn("is_processed", F.lit(False)).withColumn("processed_at", F.lit(None).cast("timestamp_ntz"))
    got = fc.with_run_flags(raw, marks, "id", "processed_through", "is_processed", "processed_at").orderBy("id").collect()
    assert [r["is_processed"] for r in got] == [True] * 5 + [False] * 2
    assert got[0]["processed_at"] == NOW and got[4]["processed_at"] == dt.datetime(2024, 2, 2)
    assert fc.watermark(marks, "processed_through") == 5
