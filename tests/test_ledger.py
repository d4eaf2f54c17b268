"""The id ledger (J-5 for D-9) and the stored states of parts (Q-1, Q-2, Q-7, G-9)."""

import datetime as dt
import re

from pyspark.sql import functions as F

from txmart.operators import fact as fc
from txmart.operators import quality as q
from txmart.operators import states
from txmart.plans import job
from txmart.sources.ledger import LEDGER, IdLedger
from txmart.sources.warehouse import Warehouse

NOW = dt.datetime(2024, 2, 1, 2)


def _delivery(root, name, ids, amount="10.50"):
    path = f"{root}/{name}.csv"
    with open(path, "w") as fh:
        fh.write("Customer ID,TransactionID,Transaction Date,Transaction Amount,Age,Branch ID,City,First Name,Last Name,Account Type\n")
        for i in ids:
            fh.write(f"C{i % 7},T{i},2024-03-04,{amount},4{i % 10},B{i % 3},oslo,ann,lee,savings\n")
    return path


def _plan(df):
    """The plan that ran (after adaptive planning)."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_history_is_joined_where_it_lies(spark, tmp_root):
    root = f"{tmp_root}/wh"
    job.run(spark, [_delivery(tmp_root, "a", range(0, 40))], root, now=NOW, batch_id="B1")
    job.run(spark, [_delivery(tmp_root, "b", range(20, 60))], root, now=NOW, batch_id="B2")
    wh = Warehouse(spark, root)
    assert wh.read(job.FACT).count() == 60
    # written and committed with the facts: nothing is left to cover, every id once
    ledger = IdLedger(wh)
    assert ledger.cover() == [] and len(wh.parts(LEDGER)) == len(wh.parts(job.FACT)) == 2
    assert sorted(r[0] for r in ledger.ids().collect()) == sorted(f"T{i}" for i in range(60))
    batch = spark.range(50, 70).select(F.concat(F.lit("T"), "id").alias("transaction_id"))
    for buckets in (ledger.buckets, 7):
        if buckets != ledger.buckets:
            ledger.rebuild(buckets)
        new = fc.absent(batch, ledger.ids(), ledger.buckets)
        assert sorted(r[0] for r in new.collect()) == [f"T{i}" for i in range(60, 70)]
        plan = _plan(new)
        assert plan.count("Exchange ") == 1 and re.search(rf"Exchange hashpartitioning\(transaction_id#\d+, {buckets}\)", plan)
        assert "Bucketed: true" in plan and f"SelectedBucketsCount: {buckets} out of {buckets}" in plan
    # other sessions read the number of buckets from the committed names, whatever they ask for
    again = IdLedger(Warehouse(spark.newSession(), root), buckets=3)
    assert again.buckets == 7 and again.ids().count() == 60


def test_ledger_heals_and_ignores_what_is_not_committed(spark, tmp_root):
    root = f"{tmp_root}/wh"
    job.run(spark, [_delivery(tmp_root, "a", range(10))], root, now=NOW, batch_id="B1")
    wh = Warehouse(spark, root)
    one = wh.read(job.FACT).where("transaction_id = 'T3'")
    renamed = one.withColumn("transaction_id", F.lit("X1")).withColumn("transaction_key", F.lit(500))
    wh.append(job.FACT, renamed)  # by hand: no ledger part, no state
    pending = wh.write(job.FACT, one.withColumn("transaction_id", F.lit("X2")))
    assert len(IdLedger(wh).cover(pending)) == 2  # written, but never committed
    wh = Warehouse(spark, root)
    assert sorted(r[0] for r in IdLedger(wh).ids().collect()) == sorted(["X1", *[f"T{i}" for i in range(10)]])
    s = job.run(spark, [_delivery(tmp_root, "b", range(5, 15))], root, now=NOW, batch_id="B2")
    keys = {r["transaction_id"]: r["transaction_key"] for r in Warehouse(spark, root).read(job.FACT).collect()}
    assert s.rows_loaded == 5 and len(keys) == 16 and sorted(keys[f"T{i}"] for i in range(10, 15)) == [501, 502, 503, 504, 505]
    # a replaced fact: parts of facts that are gone are not read
    wh = Warehouse(spark, root)
    wh.replace(job.FACT, wh.read(job.FACT).where("transaction_id = 'T1'"))
    assert [r[0] for r in IdLedger(Warehouse(spark, root)).ids().collect()] == ["T1"]
    # no fact at all
    assert IdLedger(Warehouse(spark, f"{tmp_root}/none")).ids().count() == 0


def test_old_parts_are_not_scanned_for_q1_q2(spark, tmp_root, monkeypatch):
    root = f"{tmp_root}/wh"
    for b, ids in (("B1", range(30)), ("B2", range(20, 30))):
        make, seen = states.part_states, []

        def watched(df, table, *rest):
            seen.append((table, len({f.rsplit("/", 1)[0] for f in df.inputFiles()})))
            return make(df, table, *rest)

        monkeypatch.setattr(states, "part_states", watched)
        s = job.run(spark, [_delivery(tmp_root, b, ids, f"{len(ids)}.25")], root, now=NOW, batch_id=b)
        assert (s.rows_loaded, s.overall_status) == (30 if b == "B1" else 0, "PASS" if b == "B1" else s.overall_status)
        monkeypatch.setattr(states, "part_states", make)
        assert sorted(seen) == sorted([(job.FACT, 1), (job.CLEANED, 1)])  # the new part alone
    wh = Warehouse(spark, root)
    for table, (columns, key) in job.STATE_OF.items():
        stored = job.part_states(wh, table)
        assert stored.count() == 2
        rows = wh.read(table).select(*columns)
        name = table.split(".")[1]
        assert q.profile_of_counts(states.merged_counts(stored, columns), columns, name).collect() == q.profile(rows, name).collect()
        if key:
            assert stored.agg(F.max("max_key")).first()[0] == wh.read(table).agg(F.max(key)).first()[0] == 30
    # the second run brought nothing new: its fact part is empty, and has a state of zeros
    assert sorted(r["row_count"] for r in job.part_states(wh, job.FACT).collect()) == [0, 30]


def test_two_pending_parts_of_a_new_table_are_both_read(spark, tmp_root):
    wh = Warehouse(spark, f"{tmp_root}/wh")
    rows = lambda n: spark.range(n).selectExpr("cast(id as string) as path", "timestamp_ntz'2024-01-01' as landed_at")
    changes = [wh.write("staging.landed_files", rows(n)) for n in (3, 4)]
    assert wh.read("staging.landed_files", *changes).count() == 7 and wh.read("staging.landed_files").count() == 0
    wh.commit(*changes)
    assert wh.read("staging.landed_files").count() == 7
    replaced = wh.write("staging.landed_files", rows(2), replace=True)
    assert wh.read("staging.landed_files", replaced).count() == 2


def test_states_count_nulls_ties_and_new_columns(spark):
    df = spark.createDataFrame([("p", 1, None, "a"), ("p", None, None, None), ("p", 1, "x", "a"), ("q", None, None, None)], "part string, a int, `b.c` string, k string")
    cols = ("a", "b.c")
    s = states.with_empty_parts(states.part_states(df, "t", cols, "a"), "t", ["p", "q", "r"], cols)
    assert {r["part"]: (r["row_count"], r["null_counts"], r["max_key"]) for r in s.collect()} == {
        "p": (3, {"a": 1, "b.c": 2}, 1), "q": (1, {"a": 1, "b.c": 1}, None), "r": (0, {"a": 0, "b.c": 0}, None)}
    assert states.merged_counts(states.usable(s.unionByName(s), "t", cols), cols).collect() == q.null_counts(df.select("a", "`b.c`")).collect()
    assert states.usable(s, "t", ("a", "k")).count() == 0 and states.usable(s, "u", cols).count() == 0
    assert states.merged_counts(s.where("false"), cols).first()[:] == (0, 0, 0)
