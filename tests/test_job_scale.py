"""What the job's steps must not do to scale: carry the payload along, read a source again, write a delivery anew."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from txmart.functions.text import title_case, trim_ws
from txmart.operators import states
from txmart.operators.clean import date_format_plan, parse_dates
from txmart.operators.dims import merge_products, seed_products
from txmart.plans import fixtures as fx
from txmart.plans import job, q_job

NOW = dt.datetime(2024, 1, 1)


def test_landing_places_the_inputs_before_texts_are_built(spark, tmp_path):
    root = str(tmp_path)
    d = dt.datetime(1997, 1, 1)
    spark.createDataFrame([(40, 1, 2.5, d, "5-LOW", "F"), (7, 1, 1.0, dt.datetime(1998, 5, 1), "1-URGENT", "O")],
                          "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp, o_orderpriority string, o_orderstatus string").write.parquet(f"{root}/orders.parquet")
    spark.createDataFrame([(1, "A", 3, "B")], "c_custkey long, c_name string, c_nationkey long, c_mktsegment string").write.parquet(f"{root}/customer.parquet")
    spark.createDataFrame([(3, "PERU")], "n_nationkey long, n_name string").write.parquet(f"{root}/nation.parquet")
    first, second = q_job.land_deliveries(spark, root, f"{root}/landing")
    ids = [[r["id"] for r in spark.read.option("header", True).csv(p).collect()] for p in (first, second)]
    assert sorted(ids[0], key=int) == ["40", "10000040"] and ids[1] == ["7"]
    assert "transaction_amount" not in fx.raw_inputs(spark, root).columns  # bounds are sampled over these


def test_both_deliveries_are_handed_over_although_their_files_share_names(spark, tmp_path):
    root = str(tmp_path)
    for n in (1, 2):
        (tmp_path / f"delivery={n}").mkdir()
        (tmp_path / f"delivery={n}" / "part-00000-x.csv").write_text(f"id\n{n}\n")
        q_job.hand_over(spark, f"{root}/delivery={n}", f"{root}/landing")
    assert [r["id"] for r in spark.read.option("header", True).csv(f"{root}/landing").orderBy("id").collect()] == ["1", "2"]


def test_the_batch_is_stored_without_payload_and_with_the_format_decided(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("Customer ID,TransactionID,Transaction Date\nC1,T1,2024-01-02\nC2,T2,not-a-date\n")
    seen = {}

    class Stop(Exception):
        pass

    def standardise(raw, settings, modes=None):
        seen.update(columns=raw.columns, mode=modes["_mode0"])
        raise Stop

    monkeypatch.setattr(job, "standardise", standardise)
    with pytest.raises(Stop):
        job.run(spark, [str(tmp_path / "a.csv")], f"{tmp_path}/wh", now=NOW, batch_id="B")
    assert "raw_data" not in seen["columns"] and "transaction_amount" in seen["columns"] and seen["mode"] == 0


def test_decided_formats_parse_as_the_plan_does(spark):
    for values in (["2024-01-02", "x"], ["x", "3/4/2024"], ["2024-1-2", "2024-2-3"], [None, None]):
        df = spark.createDataFrame(list(enumerate(values)), "id long, d string")
        row = date_format_plan(df, ["d"]).first()
        assert parse_dates(df, "d").orderBy("id").collect() == parse_dates(df, "d", modes=row).orderBy("id").collect()


def test_a_merge_reads_its_source_once(spark):
    read = spark.sparkContext.accumulator(0)

    def count(v):
        read.add(1)
        return v

    rows = spark.createDataFrame([(i, f"P{i % 3}") for i in range(12)], "source_row_id long, product_type string")
    counted = F.udf(count, "string").asNondeterministic()("product_type")
    merged = merge_products(seed_products(spark), rows.select("source_row_id", counted.alias("product_type")), now=NOW)
    assert merged.count() == 4 and read.value == 12


def test_part_of_a_path(spark):
    paths = spark.createDataFrame([("file:/a/v01/abc/part-0.parquet",), ("s3://b/c d/e.parquet",)], "p string")
    assert [r[0] for r in paths.select(states.part_of(F.col("p"))).collect()] == ["abc", "c d"]


def test_titles_of_ascii_texts(spark):
    texts = ["customer#000000001", "5-low", "3rd", "o'brien", "UNITED  states", " a b ", "", "x\ty", "a\x01 b", "ÀB cd", "\x00a", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    assert [r[0] for r in df.select(title_case("v")).collect()] == [None if t is None else t.title() for t in texts]
    assert [r[0] for r in df.select(trim_ws("v")).collect()] == [None if t is None else t.strip() for t in texts]
