import datetime as dt

import pytest

from pyspark.sql import functions as F

from txmart.plans import job, q_job
from txmart.sources.warehouse import Warehouse
from txmart.streaming import incremental
from conftest import SF001

NOW1, NOW2 = dt.datetime(2024, 2, 1, 2), dt.datetime(2024, 2, 2, 2)


def test_job_twice_and_redelivery_is_idempotent(spark, tmp_root):
    first, second = q_job.land_deliveries(spark, SF001, f"{tmp_root}/landing")
    wh_root = f"{tmp_root}/wh"
    s1 = job.run(spark, [first], wh_root, now=NOW1, batch_id="B1", fmt="csv")
    assert s1.rows_extracted == s1.rows_transformed + s1.rows_rejected
    assert s1.rows_loaded > 0
    wh = Warehouse(spark, wh_root)
    fact1 = wh.read(job.FACT).count()
    # the same delivery again: the file-hash guard stages nothing, nothing is loaded
    s_again = job.run(spark, [first], wh_root, now=NOW2, batch_id="B1b", fmt="csv")
    assert s_again.rows_extracted == 0 and s_again.rows_loaded == 0
    s2 = job.run(spark, [second], wh_root, now=NOW2, batch_id="B2", fmt="csv")
    wh = Warehouse(spark, wh_root)
    fact = wh.read(job.FACT)
    assert fact.count() == fact1 + s2.rows_loaded
    assert fact.select("transaction_id").distinct().count() == fact.count()
    assert fact.select("transaction_key").distinct().count() == fact.count()
    # no orphan keys
    for dim, key in ((job.CUST, "customer_key"), (job.PROD, "product_key"), (job.TIME, "time_key")):
        assert fact.join(wh.read(dim), key, "left_anti").count() == 0
    assert wh.health_check()
    # flags derived from the run marks
    raw = job.read_table(spark, wh_root, job.RAW)
    assert raw.where(~F.col("is_processed")).count() == 0
    cleaned = job.read_table(spark, wh_root, job.CLEANED)
    assert cleaned.where(~F.col("is_loaded")).count() == 0
    log = wh.read(job.RUNLOG).orderBy("execution_id").collect()
    assert [r["etl_batch_id"] for r in log] == ["B1", "B1b", "B2"]
    assert wh.read(job.METRICS).where(F.col("etl_batch_id") == "B2").count() == 11
    assert wh.sql("select count(*) as n from mart_fact_transactions").first()["n"] == fact.count()


def test_incremental_stream_matches_batch_job(spark, tmp_root):
    first, second = q_job.land_deliveries(spark, SF001, f"{tmp_root}/landing")
    landing, wh_s = f"{tmp_root}/stream_in", f"{tmp_root}/wh_stream"
    spark.read.option("header", True).csv(first).write.mode("append").option("header", True).csv(landing)
    incremental.run_available(spark, landing, wh_s, f"{tmp_root}/ckpt", now=NOW1)
    incremental.run_available(spark, landing, wh_s, f"{tmp_root}/ckpt", now=NOW1)  # nothing new
    n1 = Warehouse(spark, wh_s).read(job.FACT).count()
    assert n1 > 0
    spark.read.option("header", True).csv(second).write.mode("append").option("header", True).csv(landing)
    incremental.run_available(spark, landing, wh_s, f"{tmp_root}/ckpt", now=NOW2)
    wh_b = f"{tmp_root}/wh_batch"
    job.run(spark, [first], wh_b, now=NOW1, batch_id="B1", fmt="csv")
    job.run(spark, [second], wh_b, now=NOW2, batch_id="B2", fmt="csv")
    cols_out = ["transaction_key", "transaction_id", "customer_key", "product_key", "time_key", "branch_key", "transaction_amount"]
    a = Warehouse(spark, wh_s).read(job.FACT).select(*cols_out)
    b = Warehouse(spark, wh_b).read(job.FACT).select(*cols_out)
    assert a.count() == b.count() > n1
    assert a.exceptAll(b).count() == 0


def test_empty_delivery_raises(spark, tmp_root):
    import pytest

    from txmart.sources.files import EmptyInput

    p = f"{tmp_root}/empty.csv"
    with open(p, "w") as fh:
        fh.write("Customer ID,TransactionID\n")
    with pytest.raises(EmptyInput):
        job.run(spark, [p], f"{tmp_root}/wh")
    wh = Warehouse(spark, f"{tmp_root}/wh")
    assert wh.read(job.RAW).isEmpty() and [r["execution_status"] for r in wh.read(job.RUNLOG).collect()] == ["FAILED"]
    assert [(r["source_file_name"], r["rows_staged"], r["error"]) for r in wh.read(job.FILES).collect()] == [("empty.csv", 0, "no rows")]


def test_no_landed_row_is_missing(spark, tmp_root):
    """Files that begin with blank lines, a blank file, an empty one and one of a header alone
    beside good ones: every row is staged and every file without rows has an error row."""
    head = "Customer ID,TransactionID,Transaction Date,Transaction Amount,City,First Name,Last Name,Account Type\n"
    row = "C1,{},2024-03-04,10.00,oslo,ann,lee,savings\n"
    for name, content in {
        "good": head + row.format("T1"), "led": "\n" + head + row.format("T2"), "spaces": "  \n\n" + head + "\n" + row.format("T3") + "\n",
        "blank": "\n \n", "empty": "", "header": head,
    }.items():
        with open(f"{tmp_root}/{name}.csv", "w") as fh:
            fh.write(content)
    paths = [f"{tmp_root}/{n}.csv" for n in ("good", "led", "spaces", "blank", "empty", "header")]
    s = job.run(spark, paths, f"{tmp_root}/wh", now=NOW1, batch_id="B1")
    assert (s.rows_extracted, s.rows_loaded) == (3, 3)
    wh = Warehouse(spark, f"{tmp_root}/wh")
    ledger = {r["source_file_name"]: (r["rows_staged"], r["error"]) for r in wh.read(job.FILES).collect()}
    none = (0, "no rows")
    assert ledger == {"good.csv": (1, None), "led.csv": (1, None), "spaces.csv": (1, None), "blank.csv": none, "empty.csv": none, "header.csv": none}
    # the bad files alone fail, once for each delivery; they do not stop a stream that has seen them
    import pytest

    from txmart.sources.files import EmptyInput

    with pytest.raises(EmptyInput):
        job.run(spark, paths[3:], f"{tmp_root}/wh", now=NOW2, batch_id="B2")
    assert Warehouse(spark, f"{tmp_root}/wh").read(job.RAW).count() == 3


def test_unsupported_format(spark, tmp_root):
    import pytest

    from txmart.sources.files import read_source

    with pytest.raises(ValueError, match="Unsupported file format"):
        read_source(spark, [f"{tmp_root}/book.xlsx"])


class Broken(RuntimeError):
    pass


def _tables(spark, root):
    """Every table's rows without what names the run's wall clock."""
    wh = Warehouse(spark, root)
    out = {}
    for t in (job.RAW, job.CLEANED, job.CUST, job.PROD, job.BRAN, job.TIME, job.FACT, job.MARKS, job.METRICS, job.FILES):
        out[t] = sorted(map(repr, wh.read(t).collect()))
    log = wh.read(job.RUNLOG).where("execution_status <> 'FAILED'")
    out[job.RUNLOG] = sorted(map(repr, log.select("etl_batch_id", "execution_status", "rows_extracted", "rows_transformed", "rows_loaded", "rows_rejected").collect()))
    return out


def _small_delivery(root, name, rows, date="2024-03-04"):
    path = f"{root}/{name}.csv"
    with open(path, "w") as fh:
        fh.write("Customer ID,TransactionID,Transaction Date,Transaction Amount,Age,Branch ID,City,First Name,Last Name,Account Type\n")
        for i in range(rows):
            fh.write(f"C{i % 7},{name}{i},{date},$1{i}.50,4{i % 10},B{i % 3},oslo,ann,lee,savings\n")
    return path


@pytest.mark.parametrize("fails_at", ["staging.delivered_files", "mart.fact_transactions", "commit"])
def test_a_failed_run_leaves_nothing_and_a_retry_equals_a_clean_run(spark, tmp_root, monkeypatch, fails_at):
    path = _small_delivery(tmp_root, "T", 50)
    job.run(spark, [path], f"{tmp_root}/clean", now=NOW1, batch_id="B1")
    write, commit, armed = Warehouse.write, Warehouse.commit, [True]

    def broken_write(self, table, df, replace=False):
        if armed[0] and table == fails_at:
            armed[0] = False
            raise Broken(table)
        return write(self, table, df, replace)

    def broken_commit(self, *changes):
        if armed[0] and fails_at == "commit" and any(c.table == job.FACT for c in changes):
            armed[0] = False
            raise Broken("commit")
        return commit(self, *changes)

    monkeypatch.setattr(Warehouse, "write", broken_write)
    monkeypatch.setattr(Warehouse, "commit", broken_commit)
    with pytest.raises(Broken):
        job.run(spark, [path], f"{tmp_root}/wh", now=NOW1, batch_id="B1")
    log = Warehouse(spark, f"{tmp_root}/wh").read(job.RUNLOG).collect()
    assert [(r["execution_status"], "Broken" in r["error_message"]) for r in log] == [("FAILED", True)]
    summary = job.run(spark, [path], f"{tmp_root}/wh", now=NOW1, batch_id="B1")
    assert summary.rows_transformed == 50 and summary.rows_loaded == 50
    want, got = _tables(spark, f"{tmp_root}/clean"), _tables(spark, f"{tmp_root}/wh")
    staged_first = fails_at != "staging.delivered_files"  # the retry finds the rows staged
    for t in want:
        if staged_first and t in (job.FILES, job.RUNLOG):
            continue
        assert got[t] == want[t], t


def test_an_idle_run_judges_what_is_stored(spark, tmp_root):
    path = _small_delivery(tmp_root, "T", 40)
    root = f"{tmp_root}/wh"
    first = job.run(spark, [path], root, now=NOW1, batch_id="B1")
    again = job.run(spark, [path], root, now=NOW2, batch_id="B2")
    assert first.quality_passed and again.quality_passed and again.overall_status == "PASS" and again.rows_loaded == 0
    wh = Warehouse(spark, root)
    assert [r["execution_status"] for r in wh.read(job.RUNLOG).orderBy("execution_id").collect()] == ["SUCCESS", "SUCCESS"]
    smoke = wh.read(job.METRICS).where("etl_batch_id = 'B2' and metric_name like 'SMOKE%'").collect()
    assert {r["metric_name"]: r["record_count"] for r in smoke} == {"SMOKE_COUNT_RAW": 40, "SMOKE_COUNT_CLEANED": 40, "SMOKE_COUNT_FACT": 40}


def test_a_failing_check_is_an_error_metric(spark, tmp_root, monkeypatch):
    def broken(*a, **k):
        raise Broken("no duplicates today")

    monkeypatch.setattr(job.q, "duplicates", broken)
    summary = job.run(spark, [_small_delivery(tmp_root, "T", 10)], f"{tmp_root}/wh", now=NOW1, batch_id="B1")
    rows = Warehouse(spark, f"{tmp_root}/wh").read(job.METRICS).where("quality_status = 'ERROR'").collect()
    assert len(rows) == 2 and all("no duplicates today" in r["metric_description"] for r in rows)
    assert summary.rows_loaded == 10 and summary.overall_status == "PASS"


def test_files_per_trigger_do_not_change_the_result(spark, tmp_root):
    """A file in ISO dates and one in US dates: one column-mode decision for both."""
    import os

    landing = f"{tmp_root}/landing"
    os.makedirs(landing)
    a, b = _small_delivery(landing, "A", 40, "2024-03-04"), _small_delivery(landing, "B", 40, "03/05/2024")
    incremental.run_available(spark, landing, f"{tmp_root}/one", f"{tmp_root}/ck1", now=NOW1, max_files_per_trigger=1)
    incremental.run_available(spark, landing, f"{tmp_root}/many", f"{tmp_root}/ck2", now=NOW1, max_files_per_trigger=1000)
    job.run(spark, [a, b], f"{tmp_root}/batch", now=NOW1, batch_id="B1")
    facts = [sorted(map(repr, Warehouse(spark, f"{tmp_root}/{r}").read(job.FACT).drop("etl_batch_id").collect())) for r in ("one", "many", "batch")]
    assert facts[0] == facts[1] == facts[2] and len(facts[0]) == 40
    assert incremental.run_available(spark, landing, f"{tmp_root}/one", f"{tmp_root}/ck1", now=NOW2) is None


def test_csv_dialect_and_header_order(spark, tmp_root):
    from txmart.sources.files import read_source

    with open(f"{tmp_root}/a.csv", "w") as fh:
        fh.write('Customer ID,City,Note\n007,Oslo,"He said ""hi"", ok"\n008,Rome,"two\nlines"\n')
    with open(f"{tmp_root}/b.csv", "w") as fh:
        fh.write("City,Customer ID\nBonn,009\n")
    rows = read_source(spark, [f"{tmp_root}/a.csv", f"{tmp_root}/b.csv"]).select("Customer ID", "City", "Note").collect()
    assert sorted(map(tuple, rows), key=repr) == [("007", "Oslo", 'He said "hi", ok'), ("008", "Rome", "two\nlines"), ("009", "Bonn", None)]


def test_cli_reports_and_sql(spark, tmp_root, capsys):
    import json

    from txmart.__main__ import main

    path, root = _small_delivery(tmp_root, "T", 20), f"{tmp_root}/wh"
    assert main(["run", "--input", path, "--warehouse", root, "--date-mode", "row"]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["rows_loaded"] == 20
    for name in ("customer_summary", "product_performance", "monthly_trend", "quality_trend", "run_performance", "recent_metrics", "latest_batch_report"):
        assert main(["report", "--warehouse", root, "--name", name, "--output", f"{tmp_root}/out/{name}"]) == 0
        assert spark.read.parquet(f"{tmp_root}/out/{name}").count() > 0, name
    main(["sql", "--warehouse", root, "--query", "select count(*) as n from mart_fact_transactions", "--output", f"{tmp_root}/out/sql"])
    assert spark.read.parquet(f"{tmp_root}/out/sql").first()["n"] == 20
    assert main(["health", "--warehouse", root]) == 0


def test_old_versions_can_be_dropped(spark, tmp_root):
    import os

    wh = Warehouse(spark, f"{tmp_root}/wh")
    for n in (3, 4, 5):
        wh.replace("staging.landed_files", spark.range(n).selectExpr("cast(id as string) as path", "timestamp_ntz'2024-01-01' as landed_at"))
    wh.drop_old_versions("staging.landed_files")
    assert os.listdir(f"{tmp_root}/wh/staging/landed_files") == ["v000000003"]
    assert Warehouse(spark, wh.root).read("staging.landed_files").count() == 5
