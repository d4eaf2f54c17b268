import csv
import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from txmart.session import ensure_checkpoint_dir
from txmart.sources import csv_split, files
from txmart.sources.staging import stage_rows
from txmart.sources.warehouse import Warehouse


def test_extraction_profile_and_warehouse_basics(spark, tmp_root):
    df = spark.createDataFrame([("a", None), (None, "x"), ("c", "y")], "c1 string, c2 string")
    prof = {r["column_name"]: (r["data_type"], r["null_count"], r["row_count"]) for r in files.extraction_profile(df).collect()}
    assert prof == {"c1": ("string", 1, 3), "c2": ("string", 1, 3)}
    wh = Warehouse(spark, f"{tmp_root}/wh")
    assert not wh.health_check() and wh.row_count("mart.fact_transactions") == -1
    assert wh.read("mart.dim_time").count() == 0  # a table without a version reads empty, typed
    wh.replace("audit.etl_execution_log", wh.read("audit.etl_execution_log"))
    assert Warehouse(spark, f"{tmp_root}/wh").current_version("audit.etl_execution_log") == 1
    assert wh.row_count("audit.etl_execution_log") == 0


def _random_csv(path, rows, newline, seed):
    rng = random.Random(seed)

    def cell():
        k = rng.random()
        if k < 0.5:
            return "".join(rng.choice("abc 1") for _ in range(rng.randint(0, 6)))
        if k < 0.6:
            return 'x"y' + rng.choice(["", '"'])  # a quote inside an unquoted field is text
        return '"' + "".join(rng.choice(["a", "b", ",", '""', "\n", "\r\n", " ", "\n\n"]) for _ in range(rng.randint(0, 9))) + '"'

    with open(path, "w", newline="") as fh:
        fh.write(f'{newline}  {newline}id,"odd\nname",c{newline}')
        for i in range(rows):
            fh.write(f"{i},{cell()},{cell()}{newline}" + rng.choice(["", "", "", newline, " " + newline]))
    with open(path, newline="") as fh:
        read = [r for r in csv.reader(fh) if len(r) > 1]
    return [tuple(x or None for x in r) for r in read[1:]]


@pytest.mark.parametrize("split", ["700", "100000000"])
def test_a_csv_with_quoted_line_breaks_splits(spark, tmp_root, split):
    """Blank leading lines, a header with a line break, CRLF, stray quotes: the rows and their
    order are those of a sequential reader, whatever the size of the splits."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        for name, newline in (("a b", "\n"), ("b", "\r\n")):
            path = f"{tmp_root}/{name}.csv"
            want = _random_csv(path, 300, newline, seed=len(name))
            rows, places = files.read_delivery(spark, [path])
            got = sorted(rows.select("_pos", "id", "`odd\nname`", "c").collect())
            assert [r[0] for r in got] == list(range(300))
            assert [tuple(x or None for x in r[1:]) for r in got] == want
            assert [(r["records"], r["first"]) for r in places.collect()] == [(300, 0)]
            lines = csv_split.quoted_lines(spark, [path])
            assert (lines.rdd.getNumPartitions() > 4) == (split == "700")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_files_of_both_kinds_together(spark, tmp_root):
    """Files of one record a line and others in one delivery, each in several splits."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    try:
        want = {}
        for k, name in enumerate("abcd"):
            want[name] = [(f"{name}{i}", "x\ny" if k % 2 and i % 50 == 0 else f"v{i}") for i in range(200)]
            with open(f"{tmp_root}/{name}.csv", "w", newline="") as fh:
                csv.writer(fh).writerows([("id", "v"), *want[name]])
        got = {}
        for r in files.read_source(spark, [f"{tmp_root}/{n}.csv" for n in "abcd"]).orderBy("source_file_name", "_block", "_pos").collect():
            got.setdefault(r["source_file_name"][0], []).append((r["id"], r["v"]))
        assert got == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_an_open_quote_is_an_error(spark, tmp_root):
    with open(f"{tmp_root}/open.csv", "w") as fh:
        fh.write('id,c\n1,"never closed\n2,x\n')
    with pytest.raises(csv_split.OpenQuote, match="open.csv"):
        files.read_source(spark, [f"{tmp_root}/open.csv"])


def test_long_lines_of_quotes(spark, tmp_root):
    with open(f"{tmp_root}/long.csv", "w") as fh:
        fh.write("id,c\n1,\"" + '""x' * 50_000 + '"\n2,"' + "y\n" * 20_000 + '"\n')
    got = {r["id"]: r["c"] for r in files.read_source(spark, [f"{tmp_root}/long.csv"]).collect()}
    assert got == {"1": '"x' * 50_000, "2": "y\n" * 20_000}


def test_file_digests_keep_the_order_of_lines_and_no_setting(spark, tmp_root):
    lines = [f"{i},text {i * 7 % 13}" for i in range(400)]
    swapped = [*lines[:200], lines[201], lines[200], *lines[202:]]
    for name, content in (("a", lines), ("copy of a", lines), ("swapped", swapped), ("short", lines[:-1])):
        with open(f"{tmp_root}/{name}.csv", "w") as fh:
            fh.write("\n".join(content))
    settings = ("spark.sql.sources.binaryFile.maxLength", "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(k) for k in settings]
    seen = set()
    try:
        for length, split in (("100", "700"), ("2147483647", "2000"), ("5000", "100000000")):
            for key, value in zip(settings, (length, split)):
                spark.conf.set(key, value)
            for whole in (1, files.WHOLE_BYTES):
                got = {r["path"].rsplit("/", 1)[1]: r["source_file_hash"] for r in files.file_hashes(spark, [tmp_root], whole_bytes=whole).collect()}
                assert got["a.csv"] == got["copy%20of%20a.csv"] and len(set(got.values())) == 3
                seen.add((whole, *sorted(got.items())))
    finally:
        for key, value in zip(settings, before):
            spark.conf.set(key, value)
    assert len(seen) == 2  # by bytes and by lines, each the same under all settings
    with open(f"{tmp_root}/a.csv", "rb") as fh:
        assert dict(next(s for s in seen if s[0] > 1)[1:])["a.csv"] == hashlib.md5(fh.read()).hexdigest()


def test_rows_are_numbered_where_they_are_read(spark, tmp_root):
    """K-1 for staging: ids follow file and line, and no exchange carries the rows."""
    for name in ("a", "b"):
        with open(f"{tmp_root}/{name}.csv", "w") as fh:
            fh.write("Customer ID,TransactionID\n" + "".join(f"C{i},{name}{i}\n" for i in range(500)))
    base = spark.createDataFrame([(40,)], "_base long")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2500")
    try:
        for multi_line in (True, False):
            rows, places = files.read_delivery(spark, [f"{tmp_root}/a.csv", f"{tmp_root}/b.csv"], multi_line=multi_line)
            hashes = [(path, "h") for path, _ in files.list_files(spark, [f"{tmp_root}/a.csv", f"{tmp_root}/b.csv"])]
            staged = stage_rows(rows, files.stamp_hashes(places, hashes), base, dt.datetime(2024, 1, 1))
            got = {r["transaction_id"]: r["id"] for r in staged.select("transaction_id", "id").collect()}
            assert got == {f"{n}{i}": 41 + 500 * k + i for k, n in enumerate("ab") for i in range(500)}
            plan = staged._jdf.queryExecution().executedPlan().toString()
            assert "rangepartitioning" not in plan
            if not multi_line:  # only the one row per piece is exchanged
                assert all("raw_data" not in line for line in plan.splitlines() if "Exchange" in line)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_quoted_lines_are_ordered_in_bounded_pieces(spark, tmp_root, monkeypatch):
    """A split's lines are put in order piece by piece, wherever the pieces cut records."""
    rows = [(str(i), "a\nb" if i % 3 == 0 else f'say "{i}"\n\n,x' if i % 7 == 0 else "plain") for i in range(200)]
    with open(f"{tmp_root}/quoted.csv", "w") as f:
        f.write("id,note\n")
        for i, note in rows:
            f.write(f'{i},"{note.replace(chr(34), chr(34) * 2)}"\n')
    monkeypatch.setattr(csv_split, "PIECE_BITS", 2)
    ensure_checkpoint_dir(spark)
    lines = csv_split.quoted_lines(spark, [f"{tmp_root}/quoted.csv"]).withColumn("chunk", F.shiftright("pos", 2))
    assert csv_split.split_table(lines).count() == -(-lines.count() // 4)
    got = files.read_source(spark, [f"{tmp_root}/quoted.csv"])
    assert sorted((r["id"], r["note"]) for r in got.collect()) == sorted(rows)
    assert [r["_pos"] for r in got.orderBy(F.col("id").cast("int")).collect()] == list(range(200))
