"""Type 1 merge (D-1) and insert-if-absent (J-5) on Parquet-backed tables.

Both are pure functions: they take the current table and the incoming rows and return
the next version of the table; the caller writes it (see ``sources.warehouse``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txmart.operators.clean import keep_last
from txmart.operators.keys import assign_keys, next_key_base
from txmart.session import ensure_checkpoint_dir


class ConflictingSourceRows(ValueError):
    """Two different incoming rows for one key (the strict mode of :func:`upsert`)."""


def _now(now) -> Column:
    if now is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return now if isinstance(now, Column) else F.lit(now).cast("timestamp_ntz")


def reduce_source(source: DataFrame, key: str, order_by: str | None, on_conflicting: str = "latest", compare_cols=()) -> DataFrame:
    """One incoming row per key. ``latest``: the row with the greatest ``order_by`` wins.
    ``error``: raise if a key has two rows that differ in ``compare_cols``."""
    if on_conflicting == "error":
        cols = [key, *compare_cols]
        clashes = source.select(*cols).distinct().groupBy(key).count().where("count > 1").limit(1).count()
        if clashes:
            raise ConflictingSourceRows(f"more than one source row for some {key}")
    elif on_conflicting != "latest":
        raise ValueError(f"unknown on_conflicting {on_conflicting!r}")
    if order_by is None:
        return source.dropDuplicates([key])
    return keep_last(source, [key], order_by)


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    key_col: str,
    update_cols,
    insert_cols: dict,
    order_by: str | None = "source_row_id",
    now=None,
    on_conflicting: str = "latest",
    key_type: str = "int",
) -> DataFrame:
    """D-1: ``INSERT ... ON CONFLICT (key) DO UPDATE SET update_cols``.

    * existing keys: ``update_cols`` and ``updated_at`` take the incoming values; the
      surrogate key, ``created_at`` and every unlisted column stay;
    * new keys: inserted with ``insert_cols`` (name -> Column over the source row), a
      new surrogate key above the current maximum, and both timestamps = ``now``.
    """
    ts = _now(now)
    compare = tuple(c for c in insert_cols if c in source.columns and c != key)
    src = reduce_source(source, key, order_by, on_conflicting, compare)
    # one row per key, used three times below (updates, bounds of the new keys, new rows): the source is read once
    ensure_checkpoint_dir(source.sparkSession)
    incoming = src.select(F.col(key).alias("_k"), *[c.alias(f"_in_{n}") for n, c in insert_cols.items()]).checkpoint(eager=True)
    updates = incoming.select("_k", *[F.col(f"_in_{c}").alias(f"_up_{c}") for c in update_cols])
    kept = target.join(updates, target[key] == updates["_k"], "left")
    matched = F.col("_k").isNotNull()
    kept = kept.withColumns(
        {**{c: F.when(matched, F.col(f"_up_{c}")).otherwise(F.col(c)) for c in update_cols},
         "updated_at": F.when(matched, ts).otherwise(F.col("updated_at"))}
    ).select(*target.columns)
    return kept.unionByName(insert_new(target, incoming, key, key_col, insert_cols, ts, key_type))


def insert_new(target: DataFrame, incoming: DataFrame, key: str, key_col: str, insert_cols: dict, ts: Column, key_type: str) -> DataFrame:
    """The incoming rows whose key is absent from ``target``, with new surrogate keys."""
    fresh = incoming.join(target.select(F.col(key).alias("_k")), "_k", "left_anti")
    fresh = fresh.select(*[F.col(f"_in_{n}").alias(n) for n in insert_cols])
    keyed = assign_keys(fresh, key_col, [key], base=next_key_base(target, key_col), key_type=key_type)
    cols = []
    for f in target.schema.fields:
        if f.name in keyed.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in ("created_at", "updated_at"):
            cols.append(ts.alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return keyed.select(*cols)


def insert_if_absent(target: DataFrame, source: DataFrame, key: str, key_col: str | None = None, now=None, key_type: str = "int") -> DataFrame:
    """J-5: ``INSERT ... ON CONFLICT (key) DO NOTHING`` — existing rows win; incoming rows
    with a new key are appended, one per key (rows per key are expected to be equal, as
    for calendar rows). With ``key_col`` the new rows get keys above the current maximum."""
    ts = _now(now)
    cols = [c for c in target.columns if c in source.columns and c not in (key, key_col)]
    incoming = source.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_in_{c}") for c in cols]).dropDuplicates(["_k"])
    incoming = incoming.withColumn(f"_in_{key}", F.col("_k"))
    insert_cols = {key: F.col("_k"), **{c: F.col(f"_in_{c}") for c in cols}}
    if key_col is not None:
        return target.unionByName(insert_new(target, incoming, key, key_col, insert_cols, ts, key_type))
    fresh = incoming.join(target.select(F.col(key).alias("_k")), "_k", "left_anti")
    new_rows = fresh.select(
        *[
            (F.col(f"_in_{f.name}").cast(f.dataType) if f.name in insert_cols
             else (ts if f.name in ("created_at", "updated_at") else F.lit(None).cast(f.dataType))).alias(f.name)
            for f in target.schema.fields
        ]
    )
    return target.unionByName(new_rows)
