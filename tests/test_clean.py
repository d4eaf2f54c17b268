import datetime as dt

from pyspark.sql import functions as F

from txmart.operators import clean as cl
from txmart.operators import conform as cf

COLS = ["id", "customer_id", "transaction_id", "transaction_date", "product_type", "transaction_amount",
        "transaction_type", "account_type", "account_status", "customer_name", "customer_email", "customer_phone",
        "customer_age", "customer_segment", "branch_id", "branch_location"]


def staged(spark, rows):
    full = []
    for r in rows:
        base = dict(id=None, customer_id="C1", transaction_id="T1", transaction_date="2024-01-05", product_type=" savings ",
                    transaction_amount="$10.00", transaction_type="Deposit", account_type="A", account_status="OPEN",
                    customer_name=" jane doe ", customer_email="j@x", customer_phone=None, customer_age="30.9",
                    customer_segment="RETAIL", branch_id="B1", branch_location="new york")
        base.update(r)
        full.append(tuple(base[c] for c in COLS))
    schema = ", ".join(f"{c} {'long' if c == 'id' else 'string'}" for c in COLS)
    return spark.createDataFrame(full, schema)


def dates(df, col):
    return [r[0] for r in df.orderBy("id").select(col).collect()]


def test_column_mode_one_bad_value_defeats_format(spark):
    df = spark.createDataFrame([(1, "01/02/2024"), (2, "13/02/2024")], "id long, d string")
    out = cl.parse_dates(df, "d")
    # US fails on 13/02, so the whole column is read as EU (day first)
    assert dates(out, "d") == [dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 13)]


def test_column_mode_prefers_first_fitting_format(spark):
    df = spark.createDataFrame([(1, "01/02/2024"), (2, "03/04/2024")], "id long, d string")
    assert dates(cl.parse_dates(df, "d"), "d") == [dt.datetime(2024, 1, 2), dt.datetime(2024, 3, 4)]


def test_fallback_uses_first_value_format(spark):
    df = spark.createDataFrame([(1, "2024-01-05"), (2, "02/03/2024"), (3, "junk")], "id long, d string")
    assert dates(cl.parse_dates(df, "d"), "d") == [dt.datetime(2024, 1, 5), None, None]
    df2 = spark.createDataFrame([(1, "2024-01-05 00:00:00"), (2, "2024-01-06 10:00:00"), (3, "2024-01-07")], "id long, d string")
    assert dates(cl.parse_dates(df2, "d"), "d") == [dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6, 10), None]


def test_fallback_formats_and_a_bad_first_value(spark):
    first = lambda *v: dates(cl.parse_dates(spark.createDataFrame(list(enumerate(v)), "id long, d string"), "d"), "d")
    assert first("not-a-date", "03/04/2024", "2024-05-06") == [None, dt.datetime(2024, 3, 4), dt.datetime(2024, 5, 6)]
    assert first("Jan 5, 2024", "Feb 6, 2024", "2024-02-07") == [dt.datetime(2024, 1, 5), dt.datetime(2024, 2, 6), None]
    assert first("5/1/2024 10:00", "6/2/2024 11:30") == [dt.datetime(2024, 5, 1, 10), dt.datetime(2024, 6, 2, 11, 30)]
    assert first("5-Mar-2024", "6-Apr-2024") == [dt.datetime(2024, 3, 5), dt.datetime(2024, 4, 6)]


def test_row_mode(spark):
    df = spark.createDataFrame([(1, "2024-01-05"), (2, "02/03/2024"), (3, "13/02/2024")], "id long, d string")
    assert dates(cl.parse_dates(df, "d", mode="row"), "d") == [dt.datetime(2024, 1, 5), dt.datetime(2024, 2, 3), dt.datetime(2024, 2, 13)]


def test_clean_transactions_rules(spark):
    raw = staged(spark, [
        dict(id=1),
        dict(id=2),                                   # exact duplicate of 1 -> dropped (keep lowest id)
        dict(id=3, transaction_id="T3", transaction_amount="N/A"),
        dict(id=4, transaction_id="T4", product_type=None),
        dict(id=5, transaction_id=None),
        dict(id=6, transaction_id="T6", account_status=None, customer_segment=None, customer_age="abc"),
        dict(id=7, transaction_id="T7", transaction_amount="(25.5)"),
    ])
    out = {r["source_row_id"]: r for r in cl.clean_transactions(raw).collect()}
    assert sorted(out) == [1, 6, 7]
    assert out[1]["customer_name"] == "Jane Doe" and out[1]["branch_location"] == "New York"
    assert out[1]["product_type"] == "Savings" and out[1]["customer_age"] == 30
    assert out[6]["account_status"] == "UNKNOWN" and out[6]["customer_segment"] == "GENERAL" and out[6]["customer_age"] is None
    assert float(out[7]["transaction_amount"]) == 25.5
    counts = cl.reject_counts(raw).first().asDict()
    assert counts["rows_read"] == 7 and counts["rows_kept"] == 3 and counts["rows_rejected"] == 4
    assert counts["rejected_bad_amount"] == 1 and counts["rejected_missing_text"] == 1
    assert counts["rejected_missing_critical"] == 1 and counts["rejected_duplicate"] == 1


def test_dedupe_nulls_equal_and_lowest_id(spark):
    df = spark.createDataFrame([(3, None, "x"), (1, None, "y"), (2, "k", "z")], "id long, k string, v string")
    got = sorted(tuple(r) for r in cl.keep_first(df, ["k"], "id").collect())
    assert got == [(1, None, "y"), (2, "k", "z")]


def test_keep_first_plans_partial_group_limit(spark, capsys):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id"))
    cl.keep_first(df, ["k"], "id").explain()
    plan = capsys.readouterr().out
    # a partial limit before the shuffle: a hot key reaches its reducer as one row per map task
    assert plan.index("WindowGroupLimit") < plan.rindex("Exchange hashpartitioning")


def test_conform_headers_names_products_defaults(spark):
    df = spark.createDataFrame(
        [(" C1", "T1", "Jane ", " Doe", None, "Home Loan", None, "N/A"), ("C2", "T2", None, None, None, None, "Gold", "x")],
        "` Customer ID ` string, TransactionID string, `First Name` string, `Last Name ` string, "
        "`Account Type` string, `Loan Type` string, `Card Type` string, City string",
    )
    out = cf.conform(df).orderBy("transaction_id").collect()
    assert out[0]["customer_id"] == " C1" and out[0]["customer_name"] == "Jane Doe"
    assert out[0]["product_type"] == "Home Loan" and out[1]["product_type"] == "Gold"
    assert out[1]["customer_name"] == ""  # empty, not null
    assert out[0]["branch_location"] is None  # NA token
    assert out[0]["account_status"] == "UNKNOWN" and out[0]["customer_segment"] == "GENERAL"
    assert list(cf.conform(df).columns)[:3] == ["customer_id", "transaction_id", "transaction_date"]


def test_conform_without_name_columns_gives_null_name(spark):
    df = spark.createDataFrame([("C1", "x")], "`Customer ID` string, customer_name string")
    assert cf.conform(df).first()["customer_name"] is None


def test_conform_all_null_rows(spark):
    df = spark.createDataFrame([(None, None), ("C1", None)], "`Customer ID` string, `Account Type` string")
    assert cf.conform(df).count() == 2  # defaults are filled first, so nothing is all-null
    assert cf.conform(df, drop_empty_before_defaults=True).count() == 1
