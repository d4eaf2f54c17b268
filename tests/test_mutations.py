"""Rows that must be able to fail: with the operator turned into a no-op, the query's result
no longer equals its oracle (and does without the change)."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF001
from test_entry import _rows
from txmart.operators import dims, fact, quality
from txmart.plans import mart, q_edges, reports


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in "customer supplier part orders lineitem events nation".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


_facts, _flags, _marked = mart.new_facts, fact.with_run_flags, fact.mark_loaded


def _no_guard(cleaned, customers, products, time, branches, existing, *rest):
    return _facts(cleaned, customers, products, time, branches, existing.where("false"), *rest)


MUTATIONS = [
    ("resent_facts", mart, "new_facts", _no_guard),
    ("resent_customers", dims, "merge_customers", lambda dim, cleaned, now=None: dim),
    ("resent_dates", dims, "merge_time", lambda dim, cleaned: dim),
    ("unknown_members", fact, "UNKNOWN_KEY", 0),
    ("run_flags", fact, "with_run_flags", lambda df, *a: df),
    ("mark_loaded_some", fact, "mark_loaded", lambda cleaned, *a: cleaned),
    ("persist_cleaned", q_edges, "persist_cleaned", lambda batch, existing: batch),
    ("redelivered_files", q_edges, "new_files", lambda hashes, ledger: hashes),
    ("dq_orphans_cut", quality, "orphan_counts", lambda checks: checks[0][1].sparkSession.createDataFrame([(c[0], 0) for c in checks], "name string, orphaned_records long")),
    ("newest_sample", quality, "sample_newest", lambda df, n, **k: df),
    ("quality_trend_cut", reports, "_as_of", lambda as_of: q_edges.F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")),
    ("run_performance_cut", reports, "_as_of", lambda as_of: q_edges.F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")),
    ("na_tokens", q_edges, "null_if_na", lambda c: c),
    ("strip_unicode", q_edges, "trim_ws", lambda c: q_edges.F.regexp_replace(c, r"^\s+|\s+$", "")),
]


@pytest.mark.parametrize("name,module,attr,no_op", MUTATIONS, ids=[m[0] for m in MUTATIONS])
def test_a_no_op_makes_the_row_red(spark, duck, monkeypatch, name, module, attr, no_op):
    res = duck.execute(entry.oracle_sql()[name])
    want = _rows(res.fetchall(), [d[0] for d in res.description])
    monkeypatch.setattr(module, attr, no_op)
    df = entry.queries()[name](spark, SF001)
    assert _rows([tuple(r) for r in df.collect()], df.columns) != want


@pytest.mark.parametrize("name", ["persist_cleaned", "dq_orphans_cut", "dq_referential_cut", "newest_sample", "quality_trend_cut", "run_performance_cut", "na_tokens",
                                  "strip_unicode", "odd_dates", "csv_dialect", "redelivered_files", "unknown_members", "resent_customers", "warehouse_sql"])
def test_unchanged_the_row_is_green(spark, duck, name):
    res = duck.execute(entry.oracle_sql()[name])
    df = entry.queries()[name](spark, SF001)
    assert _rows([tuple(r) for r in df.collect()], df.columns) == _rows(res.fetchall(), [d[0] for d in res.description])
