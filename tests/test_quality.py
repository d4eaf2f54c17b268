from pyspark.sql import functions as F

from txmart.operators import quality as q


def metric(df):
    return df.first().asDict()


def test_reference_quality_frame(spark):
    df = spark.createDataFrame([(1.0, "a", 1.1), (2.0, "b", 2.2), (3.0, "c", 3.3), (None, "d", 4.4)], "col1 double, col2 string, col3 double")
    c = metric(q.completeness(df, "t"))
    assert c["metric_value"] == 91.67 and c["quality_status"] == "FAIL" and c["record_count"] == 4
    n = metric(q.null_percentages(df, "t"))
    assert n["metric_value"] == round(25 / 3, 2) and n["quality_status"] == "FAIL"
    assert '"col1":25.0' in n["metric_description"]


def test_empty_frame(spark):
    df = spark.createDataFrame([], "a string, b string")
    assert metric(q.completeness(df, "t"))["quality_status"] == "FAIL"
    n = metric(q.null_percentages(df, "t"))
    assert n["metric_value"] == 100.0 and n["quality_status"] == "FAIL"


def test_duplicates_count_all_members_nulls_equal(spark):
    df = spark.createDataFrame([(None, "x"), (None, "x"), ("k", "y")], "a string, b string")
    d = metric(q.duplicates(df, "t", ["a", "b"]))
    assert d["metric_value"] == 2 and d["quality_status"] == "WARNING" and d["metric_percentage"] == 66.67
    assert metric(q.duplicates(df, "t", ["zz"]))["quality_status"] == "SKIPPED"


def test_schema_and_referential_integrity(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    s = metric(q.schema_validation(child, "t", {"k": "int", "missing": "string"}))
    assert s["quality_status"] == "FAIL" and "missing is absent" in s["metric_description"]
    r = metric(q.referential_integrity("t", [("fk", child, "k", parent, "k")]))
    assert r["quality_status"] == "WARNING" and r["metric_value"] == 2


def test_status_fold(spark):
    def fold(statuses):
        df = spark.createDataFrame([(s,) for s in statuses], "quality_status string")
        return q.overall_status(df).first().asDict()
    assert fold(["PASS", "SKIPPED", "ERROR"]) == {"overall_status": "PASS", "passed": True}
    assert fold(["PASS", "WARNING"]) == {"overall_status": "WARNING", "passed": False}
    assert fold(["FAIL", "WARNING"])["overall_status"] == "FAIL"


def test_smoke_counts(spark):
    df = spark.range(5)
    m = metric(q.smoke_counts({"x": ("SMOKE_COUNT_X", df)}))
    assert m["record_count"] == 5 and m["metric_percentage"] is None and m["quality_status"] == "PASS"


def test_sample_newest_is_top_k(spark):
    df = spark.range(100).withColumn("created_at", F.col("id"))
    assert [r["id"] for r in q.sample_newest(df, 3).collect()] == [99, 98, 97]


def test_checks_run_side_by_side_in_their_order_and_a_failing_one_is_a_row(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "a int, b string")
    checks = [(f"t{i}", "N", lambda i=i: q.null_percentages(df, f"t{i}")) for i in range(6)]
    checks.insert(3, ("broken", "N", lambda: q.null_percentages(df.select("absent"), "broken")))
    rows = q.run_checks(spark, checks).collect()
    assert [r["table_name"] for r in rows] == ["t0", "t1", "t2", "broken", "t3", "t4", "t5"]
    assert rows[3]["quality_status"] == "ERROR" and {r["metric_value"] for r in rows if r["table_name"] != "broken"} == {25.0}
    assert q.run_checks(spark, []).count() == 0
