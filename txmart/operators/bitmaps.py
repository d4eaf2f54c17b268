"""Exact distinct counts that merge (G-2): sets of surrogate keys as bitmaps.

Surrogate keys are dense integers, so a set of them is a bitmap cut into buckets of 32,768
keys: one row ``bucket, bits`` (4 kB) per group and bucket that has any. Bitmaps are built
before the shuffle (a map task sends one row per group and bucket, however many facts it
has read), united by OR, counted by their set bits, and may be stored per day or per load and
united later: a distinct count over any range is then the OR of its parts, without the facts.

Meant for groups that hold many keys (months, products of a bank, the whole table). For very
many groups with a few keys each, a distinct list of pairs is smaller. Null keys are in no set,
as in ``count(distinct)``. Keys may be any integers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_sets(df: DataFrame, groups: dict, key: str) -> DataFrame:
    """``groups..., bucket, bits``: the set of ``key`` of every group (``groups``: name ->
    column; may be empty)."""
    k = F.col(key).cast("long")
    placed = df.where(k.isNotNull()).select(*[c.alias(n) for n, c in groups.items()], F.bitmap_bucket_number(k).alias("bucket"), F.bitmap_bit_position(k).alias("_bit"))
    return placed.groupBy(*groups, "bucket").agg(F.bitmap_construct_agg("_bit").alias("bits"))


def unite(sets: DataFrame, groups) -> DataFrame:
    """The union of sets per group (``groups``: names, fewer than the sets have, or the same
    for sets of several loads)."""
    return sets.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def cardinality(sets: DataFrame, groups, name: str) -> DataFrame:
    """``groups..., name``: how many keys each group's set holds (one row, 0 or more, when there
    are no groups)."""
    return sets.groupBy(*groups).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0).cast("long")).alias(name))
