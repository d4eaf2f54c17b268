"""Aggregate states that merge: what the nightly checks know of a table's parts (Q-1, Q-2, Q-7, G-9).

An append-only table consists of parts that never change, so what Q-1, Q-2 and the next
surrogate key need of a part (its rows, the nulls of each checked column, its greatest key)
is computed once, when the part is new, and stored as one small row. The checks of the whole
table are then sums and a maximum over these rows: no old part is scanned again, and the
result is the one of a full scan, as counts add up and maxima merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def part_of(path: Column) -> Column:
    """The name of the part that a file lies in: the folder of its path. Cut out without a pattern, as this
    runs once a row."""
    return F.substring_index(F.substring_index(path, "/", -2), "/", 1)


def part_states(df: DataFrame, table: str, columns, key: str | None = None) -> DataFrame:
    """One row per ``part`` of ``df`` (a column of that name): ``table_name, part, row_count,
    null_counts, max_key``. Combined before the shuffle, which moves one row per task and part."""
    nulls = F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*[F.count_if(F.col(f"`{c}`").isNull()) for c in columns]))
    top = F.max(F.col(f"`{key}`")).cast("long") if key else F.lit(None).cast("long")
    found = df.groupBy("part").agg(F.count(F.lit(1)).alias("row_count"), nulls.alias("null_counts"), top.alias("max_key"))
    return found.select(F.lit(table).alias("table_name"), "part", "row_count", "null_counts", "max_key")


def with_empty_parts(states: DataFrame, table: str, parts, columns) -> DataFrame:
    """``states`` and a state of zeros for each of ``parts`` that holds no row."""
    named = states.sparkSession.createDataFrame([(p,) for p in parts], "part string")
    zeros = F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*[F.lit(0).cast("long")] * len(columns)))
    return named.join(states.drop("table_name"), "part", "left").select(
        F.lit(table).alias("table_name"), "part", F.coalesce("row_count", F.lit(0).cast("long")).alias("row_count"),
        F.coalesce("null_counts", zeros).alias("null_counts"), "max_key",
    )


def usable(states: DataFrame, table: str, columns) -> DataFrame:
    """One state per part of ``table`` that counts every one of ``columns`` (a state from before
    a column was checked is not used)."""
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.map_contains_key("null_counts", F.lit(c))
    return states.where((F.col("table_name") == table) & whole).dropDuplicates(["part"])


def merged_counts(states: DataFrame, columns) -> DataFrame:
    """One row ``_rows, _n0, _n1, ...`` as :func:`quality.null_counts` gives it for the rows
    themselves."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("long"))
    return states.agg(total(F.col("row_count")).alias("_rows"), *[total(F.col("null_counts")[c]).alias(f"_n{i}") for i, c in enumerate(columns)])
