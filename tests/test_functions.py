import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from txmart.functions import calendar_columns, duration_text, rate_pct, title_case, trim_ws
from txmart.functions.values import age_to_int, amount_value
from txmart.operators.audit import batch_id_now


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {typ}")


def test_title_case_matches_python_title(spark):
    samples = ["o'brien", "NEW york-city", "3rd street", "abc123def", "  mixed\tCASE  ", "élan vital", ""]
    got = [r[0] for r in one_col(spark, samples).select(title_case(trim_ws("v"))).collect()]
    assert got == [s.strip().title() for s in samples]


def test_trim_ws_strips_tabs_and_newlines(spark):
    got = one_col(spark, ["\t a b \n", None]).select(trim_ws("v")).collect()
    assert [r[0] for r in got] == ["a b", None]


def test_amount_cleaning_rules(spark):
    values = ["$1,234.50", "(100.00)", "1e5", "1-2", "--5", "-5", ".5", "5.", "", None, "N/A", "$0.00"]
    got = [r[0] for r in one_col(spark, values).select(amount_value("v")).collect()]
    assert got == [1234.5, 100.0, 15.0, None, None, 5.0, 0.5, 5.0, None, None, None, 0.0]


def test_money_rounding_half_up(spark):
    got = one_col(spark, [2.675, 0.004], "double").select(F.col("v").cast("decimal(18,2)")).collect()
    assert [r[0] for r in got] == [Decimal("2.68"), Decimal("0.00")]


def test_age_truncates(spark):
    got = one_col(spark, ["45.7", "abc", "18", None]).select(age_to_int("v")).collect()
    assert [r[0] for r in got] == [45, None, 18, None]


def test_duration_text(spark):
    got = one_col(spark, [30, 90, 3661], "long").select(duration_text("v")).collect()
    assert [r[0] for r in got] == ["30s", "1m 30s", "1h 1m"]


def test_rates(spark):
    df = spark.createDataFrame([(1000, 950, 50), (0, 0, 0)], "t long, p long, f long")
    got = df.select(rate_pct("p", "t"), rate_pct("f", "t")).collect()
    assert [tuple(r) for r in got] == [(95.0, 5.0), (0.0, 0.0)]


def test_md5_hex(spark):
    got = one_col(spark, ["test_data"]).select(F.md5("v")).first()[0]
    assert got == "6af8307c2460f2d208ad254f04be4b0d" and len(got) == 32


def test_iso_calendar(spark):
    dates = [dt.date(2024, 12, 30), dt.date(2023, 1, 1), dt.date(1900, 1, 1), dt.date(2024, 1, 6)]
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    cal = calendar_columns(F.col("d"))
    got = df.select(cal["week_of_year"], cal["day_of_week"], cal["is_weekend"], cal["day_name"]).collect()
    assert [tuple(r) for r in got] == [(1, 1, False, "Monday"), (52, 7, True, "Sunday"), (1, 1, False, "Monday"), (1, 6, True, "Saturday")]
    sun = calendar_columns(F.col("d"), "sunday0")
    got = df.select(sun["day_of_week"], sun["is_weekend"]).collect()
    assert [tuple(r) for r in got] == [(1, False), (0, True), (1, False), (6, True)]


def test_batch_id_format():
    bid = batch_id_now(dt.datetime(2024, 1, 2, 3, 4, 5, 678000))
    assert bid == "20240102_030405_678"
