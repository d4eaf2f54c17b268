"""The nightly job (R-1): extract -> stage -> clean -> dimensions -> fact -> checks -> audit.

Two commits make a run. ``stage_files`` appends the rows of new files together with the
ledger of delivered files; ``transform`` takes every staged row no run has taken yet and
commits cleaned rows, dimensions, facts, run mark, metrics and run log at once. A run that
fails anywhere leaves nothing of the step it failed in, so running it again gives what one
clean run gives; the failure itself is logged as a FAILED run. The streaming form
(``streaming.incremental``) finds new files and calls the same ``run``.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmart import schemas
from txmart.operators import audit, dims, states
from txmart.operators import quality as q
from txmart.operators.clean import counts_of_tagged, date_format_plan, standardise, survivors_to_cleaned
from txmart.operators.fact import new_facts, take_unprocessed, watermark, with_run_flags
from txmart.operators.keys import next_key_base
from txmart.plans.mart import cleaned_layer
from txmart.session import ensure_checkpoint_dir
from txmart.settings import CANONICAL_COLUMNS, Settings
from txmart.sources import files
from txmart.sources.by_month import FactByMonth
from txmart.sources.ledger import IdLedger
from txmart.sources.staging import delivered_file_rows, new_files, persist_cleaned, stage_rows
from txmart.sources.warehouse import Warehouse

RAW, CLEANED = "staging.raw_banking_data", "staging.cleaned_banking_data"
CUST, PROD, BRAN, TIME, FACT = (f"mart.{t}" for t in ("dim_customers", "dim_products", "dim_branches", "dim_time", "fact_transactions"))
METRICS, RUNLOG = "audit.data_quality_metrics", "audit.etl_execution_log"
MARKS, FILES = "staging.run_marks", "staging.delivered_files"
STATES = "audit.part_states"
#: append-only tables whose parts have stored states: check columns, surrogate key
STATE_OF = {FACT: (q.FACT_CHECK_COLUMNS, "transaction_key"), CLEANED: (q.CLEANED_CHECK_COLUMNS, None)}


@dataclass
class RunSummary:
    batch_id: str
    rows_extracted: int
    rows_transformed: int
    rows_rejected: int
    rows_loaded: int
    quality_passed: bool
    overall_status: str
    phase_seconds: dict | None = None

    def as_dict(self) -> dict:
        return asdict(self)


def concurrently(*steps):
    """Run independent steps (each one or more Spark jobs) from threads; Spark schedules
    their jobs side by side. Returns their results in order; the first error is raised."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        return [f.result() for f in [pool.submit(step) for step in steps]]


def initialize(spark: SparkSession, wh: Warehouse) -> None:
    """S-13: all tables, with the unknown members seeded, in one commit."""
    wh.initialize({CUST: dims.seed_customers(spark), PROD: dims.seed_products(spark), TIME: dims.seed_time(spark)})


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def extract(spark: SparkSession, hashes: list, settings: Settings, fmt: str | None = None) -> tuple[DataFrame, DataFrame]:
    """S-1..S-4: rows of the files in ``hashes`` (path, hash) with file name, and where they
    were read, with each file's hash."""
    rows, places = files.read_delivery(spark, [files.plain_path(p) for p, _ in hashes], fmt, settings.csv_multi_line)
    return rows, files.stamp_hashes(places, hashes)


def stage_files(spark: SparkSession, paths, wh: Warehouse, settings: Settings, now: dt.datetime, batch_id: str,
                skip_redelivered: bool = True, fmt: str | None = None) -> int:
    """S-6, I-2: stage the rows of the delivered files that are not staged yet. Rows and file
    ledger are one commit. Returns the number of rows staged; only the list of delivered
    files (what any scan has to plan from) passes through the driver. A file without a record
    gets an error row in the ledger; if no file has one, ``EmptyInput`` is raised after that."""
    fmt = files.source_format(paths, fmt)
    listed = files.file_hashes(spark, paths)  # each file hashed once
    fresh = new_files(listed, wh.read(FILES)) if skip_redelivered else listed
    every = [tuple(r) for r in listed.select("path", "source_file_hash").orderBy("path").collect()]
    taken = [tuple(r) for r in fresh.select("path", "source_file_hash").orderBy("path").collect()]
    ledger = lambda counts: wh.write(FILES, delivered_file_rows(every, counts, batch_id, now, {p for p, _ in taken}, spark))
    if not taken:
        if every:
            wh.commit(ledger({}))
        return 0
    try:
        delivered, places = extract(spark, taken, settings, fmt)
        places = places.checkpoint(eager=True)  # one row per scanned piece of a file
        counts = {r["_source_file_path"]: r["n"] for r in places.groupBy("_source_file_path").agg(F.sum("records").alias("n")).collect()}
        if not sum(counts.values()):
            raise files.EmptyInput("the delivered files hold no rows")
    except files.EmptyInput:
        wh.commit(ledger({}))
        raise
    # staged ids above the processed watermark lie in the newest files; below it, it is the maximum
    done = watermark(wh.read(MARKS), "processed_through")
    base = next_key_base(wh.read(RAW).where(F.col("id") > done), "id", floor=max(done, 0))
    wh.commit(wh.write(RAW, stage_rows(delivered, places, base, now)), ledger(counts))
    return sum(counts.values())


def run(spark: SparkSession, paths, warehouse_root: str, settings: Settings | None = None, now: dt.datetime | None = None,
        batch_id: str | None = None, skip_redelivered: bool = True, fmt: str | None = None) -> RunSummary:
    """R-1 over delivered files (a folder of part files needs ``fmt``). An empty delivery
    raises ``EmptyInput`` (S-3): a FAILED run, with no rows staged and every empty file in the
    ledger."""
    s = settings or Settings()
    ensure_checkpoint_dir(spark)
    start = _now()
    now = now or start
    batch_id = batch_id or audit.batch_id_now(now)
    wh = Warehouse(spark, warehouse_root)
    try:
        initialize(spark, wh)
        extracted = stage_files(spark, paths, wh, s, now, batch_id, skip_redelivered, fmt) if paths else 0
        return transform(spark, wh, s, now, batch_id, start, extracted)
    except Exception as e:
        failed = Warehouse(spark, warehouse_root)  # what is committed, nothing of this run's parts
        failed.append(RUNLOG, audit.run_log_row(spark, failed.read(RUNLOG), batch_id, s.pipeline_name, s.task_name, start, _now(),
                                                False, 0, 0, 0, 0, error=f"{type(e).__name__}: {str(e)[:1000]}"))
        raise


def transform(spark: SparkSession, wh: Warehouse, s: Settings, now: dt.datetime, batch_id: str, start: dt.datetime, extracted: int) -> RunSummary:
    """Everything after staging, over all staged rows not taken yet, as one commit."""
    phases: dict[str, float] = {}
    clock = [_now()]

    def lap(name: str) -> None:
        t = _now()
        phases[name] = round((t - clock[0]).total_seconds(), 3)
        clock[0] = t

    # S-7: pending = id above the processed watermark, a pushed-down range of the newest files
    changes = []
    done = watermark(wh.read(MARKS), "processed_through")
    batch, cutoff_df = take_unprocessed(wh.read(RAW).where(F.col("id") > done))
    cutoff = cutoff_df.first()["_cut"]
    kept = rejected = loaded = 0
    if cutoff is not None:
        # one parse of the batch: every row with its reject reason (the quarantine view),
        # from which both the cleaned rows and the row accounting are derived. Stored without the
        # staged payload and provenance, which neither needs.
        # The date format is read first (one row): a choice among all in every row is too much code to compile.
        modes = None if s.date_mode == "row" else date_format_plan(batch, ["transaction_date"], s.date_formats, "id", s.fallback_date_formats).first()
        tagged = standardise(batch.select(*dict.fromkeys(("id", *CANONICAL_COLUMNS, *s.dedupe_keys, *s.critical_columns))), s, modes=modes).checkpoint(eager=True)
        counts = counts_of_tagged(tagged, s).first()
        kept, rejected = int(counts["rows_kept"]), int(counts["rows_rejected"])
        cleaned = cleaned_layer(survivors_to_cleaned(tagged, s), now)
        cleaned_part = wh.write(CLEANED, persist_cleaned(cleaned, wh.read(CLEANED).where(F.col("source_row_id") > done)))
        lap("clean")

        # D-2 .. D-5: Type 1 latest-wins, so merging the newly cleaned rows equals merging
        # all (older rows never win over newer ones). Four independent jobs side by side.
        fresh = wh.read(CLEANED, cleaned_part).where(F.col("source_row_id") > done)
        dim_parts = concurrently(
            lambda: wh.write(CUST, dims.merge_customers(wh.read(CUST), fresh, now=now), replace=True),
            lambda: wh.write(PROD, dims.merge_products(wh.read(PROD), fresh, now=now), replace=True),
            lambda: wh.write(BRAN, dims.merge_branches(wh.read(BRAN), fresh, now=now), replace=True),
            lambda: wh.write(TIME, dims.merge_time(wh.read(TIME), fresh), replace=True),
        )
        changes += [cleaned_part, *dim_parts]
        lap("dimensions")

        # D-9; then S-9/S-10 as one run mark: every row up to the cutoff is processed and
        # every cleaned row up to it is loaded (or lost to an existing transaction id)
        dim = lambda t: wh.read(t, *dim_parts)
        ledger = IdLedger(wh)
        base = next_key_base(part_states(wh, FACT), "max_key")
        fact_part = wh.write(FACT, new_facts(fresh, dim(CUST), dim(PROD), dim(TIME), dim(BRAN), wh.read(FACT), batch_id, now,
                                             ledger.ids(), ledger.buckets, base))
        mark = spark.createDataFrame([(batch_id, int(cutoff), int(cutoff), now)], schemas.RUN_MARKS)
        changes += [fact_part, *ledger.cover(fact_part), wh.write(MARKS, mark)]
        lap("fact")

    # Q-1..Q-8 over the whole tables as they will be after the commit: a run without new rows
    # judges what is stored. A check that fails is a metric with status ERROR.
    now_read = lambda t: wh.read(t, *changes)
    new_states = [change for t in STATE_OF for change in write_states(wh, t, *changes)]
    changes += new_states
    counts = {t.split(".")[1]: states.merged_counts(part_states(wh, t, *changes), STATE_OF[t][0]) for t in STATE_OF}
    if cutoff is not None:
        loaded = part_states(wh, FACT, *changes).where(F.col("part") == fact_part.part).agg(F.sum("row_count")).first()[0]
    smoke = q.smoke_checks({t: (f"SMOKE_COUNT_{n}", now_read(t)) for t, n in ((RAW, "RAW"), (CLEANED, "CLEANED"), (FACT, "FACT"))})
    suite = q.mart_checks(now_read(FACT), now_read(CLEANED), {"customers": now_read(CUST), "products": now_read(PROD),
                                                              "time": now_read(TIME), "branches": now_read(BRAN)}, s, counts=counts)
    metrics = q.run_checks(spark, [*smoke, *suite])
    overall = q.overall_status(metrics).first()  # smoke rows are always PASS: same fold
    changes.append(wh.write(METRICS, audit.metric_rows(metrics, wh.read(METRICS), batch_id, now)))
    lap("quality")
    summary = RunSummary(batch_id, extracted, kept, rejected, loaded, bool(overall["passed"]), overall["overall_status"], phases)
    changes.append(wh.write(RUNLOG, audit.run_log_row(spark, wh.read(RUNLOG), batch_id, s.pipeline_name, s.task_name, start, _now(),
                                                      summary.quality_passed, extracted, kept, loaded, rejected)))
    wh.commit(*changes)
    return summary


def write_states(wh: Warehouse, table: str, *pending) -> list:
    """Store the states of those parts of ``table`` (committed, and ``pending``) that have none,
    which is the new part alone on a usual night; the changes to commit."""
    columns, key = STATE_OF[table]
    have = {r["part"] for r in states.usable(wh.read(STATES, *pending), table, columns).select("part").collect()}  # one name per run
    missing = [p for p in wh.parts(table, *pending) if p not in have]
    if not missing:
        return []
    part = states.part_of(F.col("_metadata.file_path")).alias("part")
    rows = wh.read_parts(table, missing, *pending).select(part, *columns, *([key] if key else []))
    found = states.part_states(rows, table, columns, key)
    return [wh.write(STATES, states.with_empty_parts(found, table, missing, columns))]


def part_states(wh: Warehouse, table: str, *pending) -> DataFrame:
    """The stored states of the parts of ``table``, one row each; states that are missing are
    written and committed first unless something is pending."""
    if not pending:
        wh.commit(*write_states(wh, table))
    stored = states.usable(wh.read(STATES, *pending), table, STATE_OF[table][0])
    return stored.where(F.col("part").isin(wh.parts(table, *pending)))


def raw_with_flags(wh: Warehouse) -> DataFrame:
    """``staging.raw_banking_data`` with ``is_processed``/``processed_at`` from the run marks."""
    return with_run_flags(wh.read(RAW), wh.read(MARKS), "id", "processed_through", "is_processed", "processed_at")


def cleaned_with_flags(wh: Warehouse) -> DataFrame:
    """``staging.cleaned_banking_data`` with ``is_loaded``/``loaded_at`` from the run marks."""
    return with_run_flags(wh.read(CLEANED), wh.read(MARKS), "source_row_id", "loaded_through", "is_loaded", "loaded_at")


def read_table(spark: SparkSession, warehouse_root: str, table: str) -> DataFrame:
    """A mart table; the two staging tables come with their flags derived from the marks."""
    wh = Warehouse(spark, warehouse_root)
    if table == RAW:
        return raw_with_flags(wh)
    if table == CLEANED:
        return cleaned_with_flags(wh)
    return wh.read(table)


def facts_of(spark: SparkSession, warehouse_root: str, days) -> DataFrame:
    """G-5: the facts of the days for which ``days`` (a condition on ``mart.dim_time``) holds,
    from the files of their months alone; loads not yet laid out by month are added first."""
    wh = Warehouse(spark, warehouse_root)
    by_month = FactByMonth(wh)
    by_month.cover()
    return by_month.of(wh.read(TIME).where(days))


def table_counts(spark: SparkSession, warehouse_root: str) -> DataFrame:
    """D-10 over the warehouse: rows per mart table."""
    wh = Warehouse(spark, warehouse_root)
    return dims.dimension_counts(**{t.split(".")[1]: wh.read(t) for t in (CUST, PROD, BRAN, TIME, FACT)}).withColumn(
        "row_count", F.col("row_count").cast("long")
    )
