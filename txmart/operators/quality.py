"""Data quality checks (Q-1 .. Q-9) as one-row-per-metric DataFrames.

Every check is an aggregate over the whole table (the source system sampled the newest
50,000 rows; ``sample_newest`` restores that as an option). Checks return metric rows
lazily; nothing is collected except in :func:`passed`, which reads the folded status of
a handful of rows.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txmart.settings import STATUS_SEVERITY, Settings

# --- Fixed values: description of a skipped duplicate check ---
KEYS_MISSING = '{"reason":"Key columns not found"}'
# --- end of fixed values ---

METRIC_COLUMNS = (
    "table_name", "metric_name", "metric_value", "metric_percentage", "record_count", "quality_status", "metric_description",
)


def _metric(df: DataFrame, table: str, name: str, value: Column, pct: Column | None, count: Column, status: Column, desc: Column) -> DataFrame:
    """The metric columns; ``percentage`` falls back to ``value`` (as stored)."""
    return df.select(
        F.lit(table).alias("table_name"),
        F.lit(name).alias("metric_name"),
        value.cast("double").alias("metric_value"),
        (value if pct is None else pct).cast("double").alias("metric_percentage"),
        count.cast("long").alias("record_count"),
        status.alias("quality_status"),
        desc.alias("metric_description"),
    )


def sample_newest(df: DataFrame, n: int, order_col: str = "created_at", tie_break: str | None = None) -> DataFrame:
    """S-12: the newest ``n`` rows by ``order_col``, ties by the greatest ``tie_break`` (a
    top-k; the default suite checks all rows)."""
    order = [F.col(order_col).desc()] + ([F.col(tie_break).desc()] if tie_break else [])
    return df.orderBy(*order).limit(n)


def profile(df: DataFrame, table: str, settings: Settings | None = None, checks=("COMPLETENESS_PCT", "NULL_PERCENTAGE")) -> DataFrame:
    """Q-1 and Q-2 from one aggregate (row count and nulls per column), one row per check.

    Q-1: (cells - null cells) / cells * 100, 0 when there are no cells; PASS when
    ``>= min_completeness_pct`` else FAIL. Q-2: mean over columns of the column's null %;
    an empty table counts 100 % per column; PASS when ``<= max_null_pct`` else FAIL; the
    description carries the per-column percentages."""
    return profile_of_counts(null_counts(df), df.columns, table, settings, checks)


def null_counts(df: DataFrame) -> DataFrame:
    """One row: ``_rows`` and the nulls ``_n0, _n1, ...`` of each column."""
    return df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}") for i, c in enumerate(df.columns)])


def profile_of_counts(counts: DataFrame, columns, table: str, settings: Settings | None = None, checks=("COMPLETENESS_PCT", "NULL_PERCENTAGE")) -> DataFrame:
    """:func:`profile` from the counts of :func:`null_counts`, or from those that merged states
    give (``states.merged_counts``)."""
    s = settings or Settings()
    k = len(columns)
    rows = F.col("_rows")
    cells = rows * F.lit(k)
    nulls = sum((F.col(f"_n{i}") for i in range(k)), F.lit(0))
    full = F.when(cells > 0, (cells - nulls).cast("double") / cells * 100.0).otherwise(F.lit(0.0))
    per_col = [F.when(rows > 0, F.col(f"_n{i}").cast("double") / rows * 100.0).otherwise(F.lit(100.0)) for i in range(k)]
    mean = (sum(per_col, F.lit(0.0)) / F.lit(k)) if k else F.lit(0.0)
    text = F.to_json(F.struct(F.round(full, 2).alias("value"), F.lit(s.min_completeness_pct).alias("threshold"), rows.alias("record_count")))
    details = F.to_json(F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*per_col))) if k else F.lit("{}")
    found = {
        "COMPLETENESS_PCT": (F.round(full, 2), F.when(full >= s.min_completeness_pct, "PASS").otherwise("FAIL"), text),
        "NULL_PERCENTAGE": (F.round(mean, 2), F.when(mean <= s.max_null_pct, "PASS").otherwise("FAIL"), details),
    }
    each = F.array(*[F.struct(F.lit(n).alias("m"), found[n][0].cast("double").alias("v"), found[n][1].alias("s"), found[n][2].alias("d")) for n in checks])
    return counts.select("_rows", F.explode(each).alias("_x")).select(
        F.lit(table).alias("table_name"), F.col("_x.m").alias("metric_name"), F.col("_x.v").alias("metric_value"), F.col("_x.v").alias("metric_percentage"),
        F.col("_rows").cast("long").alias("record_count"), F.col("_x.s").alias("quality_status"), F.col("_x.d").alias("metric_description"),
    )


def completeness(df: DataFrame, table: str, settings: Settings | None = None) -> DataFrame:
    """Q-1 alone (see :func:`profile`)."""
    return profile(df, table, settings, ("COMPLETENESS_PCT",))


def null_percentages(df: DataFrame, table: str, settings: Settings | None = None) -> DataFrame:
    """Q-2 alone (see :func:`profile`)."""
    return profile(df, table, settings, ("NULL_PERCENTAGE",))


def duplicates(df: DataFrame, table: str, keys) -> DataFrame:
    """Q-3: rows that belong to a duplicate group of ``keys`` (every member counts, nulls
    equal); WARNING when any, SKIPPED when a key column is missing.

    A group-by with partial aggregation: a hot key costs one partial row per map task.
    """
    keys = list(keys)
    spark = df.sparkSession
    if not all(k in df.columns for k in keys):
        one = spark.range(1)
        return _metric(one, table, "DUPLICATES", F.lit(None), F.lit(None), F.lit(None), F.lit("SKIPPED"),
                       F.lit(KEYS_MISSING))
    groups = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    agg = groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"), F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("_dups"))
    pct = F.when(F.col("_rows") > 0, F.round(F.col("_dups").cast("double") / F.col("_rows") * 100.0, 2)).otherwise(F.lit(0.0))
    status = F.when(F.col("_dups") == 0, "PASS").otherwise("WARNING")
    desc = F.to_json(F.struct(F.array(*[F.lit(k) for k in keys]).alias("key_columns")))
    return _metric(agg, table, "DUPLICATES", F.col("_dups"), pct, F.col("_rows"), status, desc)


def schema_errors(df: DataFrame, expected: dict) -> list[str]:
    """Where the frame's types depart from ``expected`` (column -> part of a Spark type name,
    e.g. ``decimal`` for ``decimal(18,2)``), by column name."""
    have = dict(df.dtypes)
    absent = [f"{c} is absent" for c in sorted(expected.keys() - have.keys())]
    wrong = {c: t for c, t in have.items() if c in expected and expected[c] not in t}
    return absent + [f"{c} has type {t} instead of {expected[c]}" for c, t in sorted(wrong.items())]


def schema_validation(df: DataFrame, table: str, expected: dict) -> DataFrame:
    """Q-4: FAIL with the list of errors, else PASS (schema metadata only; the record
    count is one aggregate)."""
    errors = schema_errors(df, expected)
    status = F.lit("FAIL" if errors else "PASS")
    desc = F.to_json(F.struct(F.array(*[F.lit(e) for e in errors]).cast("array<string>").alias("errors")))
    return _metric(df.agg(F.count("*").alias("_rows")), table, "SCHEMA_VALIDATION", F.lit(None), F.lit(None), F.col("_rows"), status, desc)


def orphan_counts(checks) -> DataFrame:
    """J-6: per check ``(name, child, child_key, parent, parent_key)``, the child rows whose
    key has no parent (a null child key counts as an orphan, as in ``LEFT JOIN ... WHERE
    parent.key IS NULL``).

    Checks of one child frame share one scan: the child's keys are counted per combination
    first (combined map-side), then left-joined to each parent's distinct keys."""
    out = None
    children: list[tuple[DataFrame, list]] = []
    for c in checks:
        for df, mine in children:
            if df is c[1]:
                mine.append(c)
                break
        else:
            children.append((c[1], [c]))
    for df, mine in children:
        keys = list(dict.fromkeys(c[2] for c in mine))
        rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        for i, (_, _, key, parent, pkey) in enumerate(mine):
            known = parent.select(F.col(pkey).alias(f"_pk{i}")).distinct()
            rows = rows.join(known, F.col(key) == F.col(f"_pk{i}"), "left")
        lost = rows.agg(*[F.coalesce(F.sum(F.when(F.col(f"_pk{i}").isNull(), F.col("_n"))), F.lit(0)).alias(f"_o{i}") for i in range(len(mine))])
        pairs = F.explode(F.array(*[F.struct(F.lit(c[0]).alias("name"), F.col(f"_o{i}").alias("orphaned_records")) for i, c in enumerate(mine)]))
        part = lost.select(pairs.alias("_p")).select("_p.name", "_p.orphaned_records")
        out = part if out is None else out.unionByName(part)
    return out


def referential_integrity(table: str, checks) -> DataFrame:
    """Q-5: WARNING when any check finds orphans; the description lists them."""
    counts = orphan_counts(checks)
    bad = F.col("orphaned_records") > 0
    agg = counts.agg(
        F.count_if(bad).alias("_bad"),
        F.sum("orphaned_records").alias("_orphans"),
        F.to_json(F.filter(F.collect_list(F.struct("name", "orphaned_records")), lambda x: x["orphaned_records"] > 0)).alias("_desc"),
    )
    status = F.when(F.col("_bad") > 0, "WARNING").otherwise("PASS")
    return _metric(agg, table, "REFERENTIAL_INTEGRITY", F.col("_orphans"), F.lit(None), F.lit(None), status, F.col("_desc"))


def severity(status: Column) -> Column:
    expr = None
    for name, rank in STATUS_SEVERITY.items():
        expr = F.when(status == name, F.lit(rank)) if expr is None else expr.when(status == name, F.lit(rank))
    return expr


def overall_status(metrics: DataFrame) -> DataFrame:
    """Q-6: one row ``overall_status``/``passed``: the most severe of PASS < WARNING <
    FAIL; ERROR and SKIPPED never change it; passed means exactly PASS."""
    names = {rank: name for name, rank in STATUS_SEVERITY.items()}
    top = F.coalesce(F.max(severity(F.col("quality_status"))), F.lit(0))
    expr = None
    for rank, name in sorted(names.items()):
        expr = F.when(top == rank, F.lit(name)) if expr is None else expr.when(top == rank, F.lit(name))
    return metrics.agg(expr.alias("overall_status")).withColumn("passed", F.col("overall_status") == "PASS")


def raw_suite(raw: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Q-7 with a frame: completeness, null % and duplicates of the staged batch."""
    s = settings or Settings()
    out = profile(raw, "raw_banking_data", s)
    if s.duplicate_check_enabled:
        out = out.unionByName(duplicates(raw, "raw_banking_data", s.dedupe_keys))
    return out


FACT_CHECK_COLUMNS = ("transaction_id", "customer_key", "product_key", "time_key", "transaction_amount", "transaction_date")
CLEANED_CHECK_COLUMNS = ("customer_id", "transaction_id", "transaction_date", "transaction_amount")
EXPECTED_FACT_TYPES = {
    "transaction_id": "string", "customer_key": "int", "product_key": "int", "time_key": "int",
    "transaction_amount": "decimal", "transaction_date": "date",
}


def mart_checks(
    fact: DataFrame,
    cleaned: DataFrame,
    dims: dict | None = None,
    settings: Settings | None = None,
    sample_rows: int | None = None,
    counts: dict | None = None,
) -> list:
    """Q-7 without a frame, as ``(table, check, build)``: Q-1..Q-3 on the fact (key
    ``transaction_id``) and the cleaned table (the dedupe key); plus Q-4 on the fact and Q-5
    fact -> dimensions when ``dims`` is given (the source suite documents but never calls
    those two). ``build`` returns the metric rows. ``counts`` (table -> the row of
    :func:`null_counts` of its check columns) spares Q-1 and Q-2 their scans; a sample has none."""
    s = settings or Settings()
    f, c = fact, cleaned
    known = {} if sample_rows else counts or {}
    if sample_rows:
        f, c = sample_newest(fact, sample_rows, tie_break="transaction_key"), sample_newest(cleaned, sample_rows, tie_break="source_row_id")
    f, c = f.select(*FACT_CHECK_COLUMNS), c.select(*CLEANED_CHECK_COLUMNS)

    def profiled(df: DataFrame, table: str) -> DataFrame:
        return profile_of_counts(known[table] if table in known else null_counts(df), df.columns, table, s)

    checks = [("fact_transactions", "PROFILE", lambda: profiled(f, "fact_transactions")), ("cleaned_banking_data", "PROFILE", lambda: profiled(c, "cleaned_banking_data"))]
    if s.duplicate_check_enabled:
        checks.append(("fact_transactions", "DUPLICATES", lambda: duplicates(f, "fact_transactions", ["transaction_id"])))
        checks.append(("cleaned_banking_data", "DUPLICATES", lambda: duplicates(c, "cleaned_banking_data", s.dedupe_keys)))
    if dims is not None:
        checks.append(("fact_transactions", "SCHEMA_VALIDATION", lambda: schema_validation(fact, "fact_transactions", EXPECTED_FACT_TYPES)))
        keys = fact.select("customer_key", "product_key", "time_key", F.coalesce("branch_key", F.lit(-1)).alias("branch_key"))
        no_branch = dims["branches"].select("branch_key").unionByName(fact.sparkSession.range(1).select(F.lit(-1).cast("int").alias("branch_key")))
        foreign = [
            ("fact_customer_fk", keys, "customer_key", dims["customers"], "customer_key"),
            ("fact_product_fk", keys, "product_key", dims["products"], "product_key"),
            ("fact_time_fk", keys, "time_key", dims["time"], "time_key"),
            ("fact_branch_fk", keys, "branch_key", no_branch, "branch_key"),  # an unknown branch is allowed
        ]
        checks.append(("fact_transactions", "REFERENTIAL_INTEGRITY", lambda: referential_integrity("fact_transactions", foreign)))
    return checks


def mart_suite(fact: DataFrame, cleaned: DataFrame, dims: dict | None = None, settings: Settings | None = None, sample_rows: int | None = None) -> DataFrame:
    """The rows of :func:`mart_checks` as one lazy frame."""
    out = None
    for _, _, build in mart_checks(fact, cleaned, dims, settings, sample_rows):
        out = build() if out is None else out.unionByName(build())
    return out


def run_checks(spark: SparkSession, checks, at_once: int = 4) -> DataFrame:
    """Run each check by itself and return all metric rows in the order of ``checks``; one that
    fails becomes a row with status ERROR and the suite goes on. The checks do not depend on
    each other: ``at_once`` of them plan and run side by side. A check yields a few rows, which
    pass through here."""
    def one(check) -> list:
        table, name, build = check
        try:
            return [tuple(r) for r in build().select(*METRIC_COLUMNS).collect()]
        except Exception as e:  # noqa: BLE001 - the failure is what the row reports
            return [(table, name, None, None, None, "ERROR", f"{type(e).__name__}: {str(e)[:500]}")]

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        found = [pool.submit(one, check) for check in checks]
        rows = [row for f in found for row in f.result()]
    return spark.createDataFrame(rows, METRICS_DDL)


METRICS_DDL = (
    "table_name string, metric_name string, metric_value double, metric_percentage double, "
    "record_count bigint, quality_status string, metric_description string"
)


def smoke_checks(tables: dict) -> list:
    """Q-8 as checks: the row count of each whole table as a metric row (always PASS)."""
    def count(table, metric, df):
        n = F.col("_rows")
        status = F.when(n >= 0, "PASS").otherwise("FAIL")
        return _metric(df.agg(F.count("*").alias("_rows")), table, metric, n, F.lit(None), n, status, F.concat(F.lit(table), F.lit(" has "), n.cast("string"), F.lit(" rows")))

    return [(table, metric, lambda t=table, m=metric, d=df: count(t, m, d)) for table, (metric, df) in tables.items()]


def smoke_counts(tables: dict) -> DataFrame:
    """Q-8 as one lazy frame."""
    out = None
    for _, _, build in smoke_checks(tables):
        out = build() if out is None else out.unionByName(build())
    return out
