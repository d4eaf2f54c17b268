"""Cleaning a staged batch (C-1 .. C-10): dates, amounts, text, missing values, duplicates.

The source order is kept: dates -> amounts -> text -> critical nulls -> defaults ->
keep-first dedupe. Each step is a projection/filter except two:

* the column-mode date format (C-1) is decided by one global aggregate whose result is a
  single row, joined back by broadcast — the job stays lazy and nothing is collected;
* keep-first (C-8) is ``row_number() == 1`` over the duplicate key, which Spark plans
  with a partial ``WindowGroupLimit`` before the shuffle, so a hot key is cut down to one
  row per map task before it reaches its reducer.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txmart.functions.calendar import parse_ts, parse_with_formats
from txmart.functions.text import title_case, trim_ws
from txmart.functions.values import age_to_int, amount_value
from txmart.schemas import MONEY
from txmart.settings import TITLE_COLUMNS, Settings

# --- Fixed values: reject reasons, in the order the steps run ---
REJECT_REASONS = ("bad_date", "bad_amount", "missing_text", "missing_critical", "duplicate")
# --- end of fixed values ---

CLEANED_COLUMNS = (
    "source_row_id", "customer_id", "transaction_id", "transaction_date", "product_type",
    "transaction_amount", "transaction_type", "account_type", "account_status", "customer_name",
    "customer_email", "customer_phone", "customer_age", "customer_segment", "branch_id",
    "branch_location",
)


# ------------------------------------------------------------------ C-1 / C-2 dates

def date_format_plan(df: DataFrame, cols, formats=None, order_col: str = "id", fallback=None) -> DataFrame:
    """One row with a column ``_mode{i}`` per date column, decided by one aggregate.

    The mode is the index (in ``formats`` then ``fallback``) of the one format the column
    is read with: the first of ``formats`` that parses every non-null value; if none does,
    the first of all that parses the column's first non-null value (by ``order_col``), and
    the values in another format are lost; -1 when no format parses that first value: then
    each value takes the first format that parses it."""
    formats = tuple(formats or Settings().date_formats)
    every = (*formats, *(Settings().fallback_date_formats if fallback is None else fallback))
    aggs = []
    for k, name in enumerate(cols):
        c = F.col(name)
        aggs += [F.coalesce(F.bool_and(c.isNull() | parse_ts(c, f).isNotNull()), F.lit(True)).alias(f"_fit{k}_{i}") for i, f in enumerate(formats)]
        aggs.append(F.min_by(c, F.when(c.isNotNull(), F.col(order_col))).alias(f"_first{k}"))
    stats = df.agg(*aggs)
    modes = []
    for k, _ in enumerate(cols):
        mode = reduce(lambda acc, i, k=k: acc.when(F.col(f"_fit{k}_{i}"), F.lit(i)), range(1, len(formats)), F.when(F.col(f"_fit{k}_0"), F.lit(0)))
        for i, f in enumerate(every):
            mode = mode.when(parse_ts(F.col(f"_first{k}"), f).isNotNull(), F.lit(i))
        modes.append(mode.otherwise(F.lit(-1)).alias(f"_mode{k}"))
    return stats.select(*modes)


def _parse_by_mode(c: Column, mode: Column, formats) -> Column:
    expr = F.when(mode == 0, parse_ts(c, formats[0]))
    for i, f in enumerate(formats[1:], start=1):
        expr = expr.when(mode == i, parse_ts(c, f))
    return expr.otherwise(F.coalesce(parse_with_formats(c, formats), parse_ts(c)))


def parse_dates(df: DataFrame, col="transaction_date", formats=None, mode: str = "column", order_col: str = "id", fallback=None, modes=None) -> DataFrame:
    """Replace ``col`` (a name or several) by its ``timestamp_ntz`` parse (null where it does
    not parse).

    ``mode="column"``: one format per column, chosen by :func:`date_format_plan` (one bad
    value defeats a format, as in the source system). ``mode="row"``: each value takes the
    first format that parses it (robust choice for users). ``modes``: the row of a
    :func:`date_format_plan` that the caller has read; only the formats it chose are compiled.
    """
    cols = [col] if isinstance(col, str) else list(col)
    formats = tuple(formats or Settings().date_formats)
    every = (*formats, *(Settings().fallback_date_formats if fallback is None else fallback))
    if mode == "row":
        return df.withColumns({c: F.coalesce(parse_with_formats(F.col(c), every), parse_ts(F.col(c))) for c in cols})
    if mode != "column":
        raise ValueError(f"unknown date mode {mode!r}")
    if modes is not None:
        return df.withColumns({c: _parse_by_mode(F.col(c), F.lit(modes[f"_mode{k}"]), every) for k, c in enumerate(cols)})
    plan = date_format_plan(df, cols, formats, order_col, fallback)
    parsed = {c: _parse_by_mode(F.col(c), F.col(f"_mode{k}"), every) for k, c in enumerate(cols)}
    return df.crossJoin(F.broadcast(plan)).withColumns(parsed).drop(*[f"_mode{k}" for k in range(len(cols))])


def clean_dates(df: DataFrame, col: str = "transaction_date", formats=None, mode: str = "column", order_col: str = "id") -> DataFrame:
    """C-1/C-2: parse, then drop rows whose date did not parse."""
    return parse_dates(df, col, formats, mode, order_col).where(F.col(col).isNotNull())


# ------------------------------------------------------------------ C-3 amounts

def clean_amounts(df: DataFrame, col: str = "transaction_amount") -> DataFrame:
    """C-3: keep rows whose cleaned absolute amount is > 0; store as decimal(18,2)."""
    v = amount_value(F.col(col))
    return df.withColumn(col, v).where(F.col(col) > 0).withColumn(col, F.col(col).cast(MONEY))


# ------------------------------------------------------------------ C-4 text

def clean_text(df: DataFrame, cols=TITLE_COLUMNS) -> DataFrame:
    """C-4: strip and title-case; a null in any of ``cols`` drops the row."""
    present = [c for c in cols if c in df.columns]
    out = df.withColumns({c: title_case(trim_ws(F.col(c))) for c in present})
    return out.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in present], F.lit(True)))


# ------------------------------------------------------------------ C-5 / C-6 missing values

def drop_critical(df: DataFrame, cols=None) -> DataFrame:
    """C-5: drop rows lacking any critical column."""
    cols = [c for c in (cols or Settings().critical_columns) if c in df.columns]
    return df.na.drop(subset=cols) if cols else df


def fill_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """C-6: fill remaining nulls of status/product/segment with their defaults."""
    defaults = {k: v for k, v in (defaults or Settings().fill_defaults).items() if k in df.columns}
    return df.na.fill(defaults) if defaults else df


# ------------------------------------------------------------------ C-8 dedupe

def keep_first(df: DataFrame, keys, order_by) -> DataFrame:
    """C-8: per ``keys`` (nulls equal) keep the row that sorts first by ``order_by``."""
    order = [F.col(c) if isinstance(c, str) else c for c in ([order_by] if isinstance(order_by, (str, Column)) else order_by)]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def keep_last(df: DataFrame, keys, order_by) -> DataFrame:
    """Per ``keys`` keep the row that sorts last by ``order_by`` (latest wins)."""
    cols = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    return keep_first(df, keys, [(F.col(c) if isinstance(c, str) else c).desc() for c in cols])


# ------------------------------------------------------------------ C-9 age

def clean_age(df: DataFrame, col: str = "customer_age") -> DataFrame:
    """C-9: numeric-or-null, truncated to int."""
    return df.withColumn(col, age_to_int(F.col(col)))


# ------------------------------------------------------------------ composition, C-10 accounting

def standardise(raw: DataFrame, settings: Settings | None = None, date_mode: str | None = None, modes=None) -> DataFrame:
    """Every staged row with typed columns and ``reject_reason`` (null if the row survives
    the row-level steps; duplicates are decided afterwards by :func:`clean_transactions`).
    ``modes``: see :func:`parse_dates`."""
    s = settings or Settings()
    out = parse_dates(raw, "transaction_date", s.date_formats, date_mode or s.date_mode, "id", s.fallback_date_formats, modes)
    amount = amount_value(F.col("transaction_amount"))
    out = out.withColumn("transaction_amount", amount)
    out = out.withColumns({c: title_case(trim_ws(F.col(c))) for c in TITLE_COLUMNS})
    critical = [c for c in s.critical_columns if c not in ("transaction_date", "transaction_amount")]
    reason = (
        F.when(F.col("transaction_date").isNull(), F.lit("bad_date"))
        .when(F.col("transaction_amount").isNull() | (F.col("transaction_amount") <= 0), F.lit("bad_amount"))
        .when(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in TITLE_COLUMNS]), F.lit("missing_text"))
        .when(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in critical]), F.lit("missing_critical"))
    )
    return out.withColumn("reject_reason", reason).withColumn("transaction_amount", F.col("transaction_amount").cast(MONEY))


def clean_transactions(raw: DataFrame, settings: Settings | None = None, date_mode: str | None = None) -> DataFrame:
    """C-1..C-9 over a staged batch (``id`` + canonical columns) -> cleaned rows.

    Equivalent to dates -> amounts -> text -> critical nulls -> defaults -> keep-first by
    ``id`` on (customer_id, transaction_id, transaction_date), then the age parse.
    """
    s = settings or Settings()
    return survivors_to_cleaned(standardise(raw, s, date_mode), s)


def survivors_to_cleaned(tagged: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The cleaned rows of a :func:`standardise` result (defaults, keep-first, age)."""
    s = settings or Settings()
    kept = tagged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    kept = fill_defaults(kept, s.fill_defaults)
    kept = keep_first(kept, s.dedupe_keys, "id")
    kept = clean_age(kept)
    return kept.withColumnRenamed("id", "source_row_id").select(*CLEANED_COLUMNS)


def reject_counts(raw: DataFrame, settings: Settings | None = None, date_mode: str | None = None) -> DataFrame:
    """C-10: one row — rows read, kept, rejected, and rejected per reason.

    Duplicates are counted from a group-by on the dedupe key (partial aggregation, so a
    hot key costs one row per map task), not by materialising the dropped rows.
    """
    s = settings or Settings()
    return counts_of_tagged(standardise(raw, s, date_mode), s)


def counts_of_tagged(tagged: DataFrame, settings: Settings | None = None) -> DataFrame:
    """C-10 over a :func:`standardise` result."""
    s = settings or Settings()
    reason = F.col("reject_reason")
    # rows per reason and (for survivors) per dedupe key, then one small aggregate: the
    # batch is read once, and a hot key is one partial row per map task
    keys = [F.when(reason.isNull(), F.col(k)).alias(k) for k in s.dedupe_keys]
    groups = tagged.select("reject_reason", *keys).groupBy("reject_reason", *s.dedupe_keys).agg(F.count(F.lit(1)).alias("_n"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    out = groups.agg(
        total("_n").alias("rows_read"),
        *[total(F.when(reason == r, F.col("_n"))).alias(f"rejected_{r}") for r in REJECT_REASONS[:-1]],
        F.count_if(reason.isNull()).alias("rows_kept"),
        total(F.when(reason.isNull(), F.col("_n") - 1)).alias("rejected_duplicate"),
    )
    return out.withColumn("rows_rejected", F.col("rows_read") - F.col("rows_kept"))


def missing_profile(df: DataFrame) -> DataFrame:
    """S-5/C-7: per column, its null count and the row count (one aggregate, unpivoted)."""
    cols = df.columns
    wide = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    stacked = wide.select(
        "_rows",
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_count")) for i, c in enumerate(cols)])).alias("_p"),
    )
    return stacked.select("_p.column_name", "_p.null_count", F.col("_rows").alias("row_count"))
