"""Facts laid out by month: what is read, what a rerun leaves, which rows have a day."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from txmart import schemas
from txmart.operators import dims
from txmart.plans import job, reports
from txmart.sources.by_month import FactByMonth
from txmart.sources.warehouse import Warehouse


def facts(spark, rows):
    df = spark.createDataFrame(rows, "transaction_id string, customer_key int, transaction_amount int, transaction_date date")
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.FACT.fields])


def some(spark, first, n, month=None):
    day = lambda i: dt.date(2024, month or 1 + i % 4, 1 + i % 28)
    return facts(spark, [(f"t{first + i}", i % 7, i, day(i)) for i in range(n)])


def days(spark):
    every = spark.range(366).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date"))
    return dims.time_rows(every).withColumn("time_key", F.dayofyear("date"))


@pytest.fixture()
def wh(spark, tmp_root):
    w = Warehouse(spark, f"{tmp_root}/wh")
    w.append(job.TIME, days(spark))
    return w


def ids(df):
    return sorted(r[0] for r in df.select("transaction_id").collect())


def test_a_report_of_one_month_reads_no_file_of_another(spark, wh):
    wh.append(job.FACT, some(spark, 0, 200))
    wh.append(job.FACT, some(spark, 200, 100))
    expected = reports.monthly_trend(wh.read(job.FACT).where("month(transaction_date) = 2")).collect()
    assert len(FactByMonth(wh).cover()) == 2
    for path in glob.glob(f"{wh.root}/mart/fact_by_month/month=*/part=*/*.parquet"):
        if "month=2024-02-01" not in path:
            with open(path, "wb") as f:
                f.write(b"no parquet file")
    found = job.facts_of(spark, wh.root, "year = 2024 and month = 2")
    assert "dynamicpruning" in found._jdf.queryExecution().toString()
    assert reports.monthly_trend(found).collect() == expected and len(expected) == 1
    with pytest.raises(Exception, match="(?i)parquet"):  # the other files are really there
        job.facts_of(spark, wh.root, "month = 3").count()


def test_only_new_parts_are_laid_out_and_a_second_attempt_doubles_nothing(spark, wh, monkeypatch):
    wh.append(job.FACT, some(spark, 0, 50))
    assert len(FactByMonth(wh).cover()) == 1 and FactByMonth(wh).cover() == []
    wh.append(job.FACT, some(spark, 50, 50))
    again = Warehouse(spark, wh.root)
    with monkeypatch.context() as m:  # the files are written, the marker is not
        m.setattr(again, "commit", lambda *c: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            FactByMonth(again).cover()
    assert len(ids(FactByMonth(Warehouse(spark, wh.root)).read())) == 50
    assert ids(job.facts_of(spark, wh.root, "true")) == sorted(f"t{i}" for i in range(100))


def test_replaced_facts_are_not_read_any_more(spark, wh):
    wh.append(job.FACT, some(spark, 0, 30))
    FactByMonth(wh).cover()
    wh.replace(job.FACT, some(spark, 100, 5, month=2))
    assert ids(job.facts_of(spark, wh.root, "true")) == [f"t{100 + i}" for i in range(5)]


def test_no_facts_no_date_and_repeated_days(spark, wh):
    assert job.facts_of(spark, wh.root, "true").count() == 0
    wh.append(job.FACT, facts(spark, [("a", 1, 1, None), ("b", 1, 1, dt.date(2024, 2, 29)), ("c", 1, 1, dt.date(1999, 1, 1)), ("b", 1, 1, dt.date(2024, 2, 29))]))
    assert ids(job.facts_of(spark, wh.root, "true")) == ["b", "b"]  # repeated rows stay; no day, or one the calendar lacks: left out
    layout = FactByMonth(Warehouse(spark, wh.root))
    assert ids(layout.read()) == ["a", "b", "b", "c"]
    twice = days(spark).unionByName(days(spark))
    assert ids(layout.of(twice)) == ["b", "b"]
    assert layout.of(twice).columns == [f.name for f in schemas.FACT.fields]
