"""Helpers shared by the operators: tables, words, registry, scratch tables, components."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from txmart.session import ensure_checkpoint_dir, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: a word is a run of characters other than the six ASCII blanks
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
U64 = np.uint64


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``; ``sql`` is its DuckDB oracle."""

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read whole by Spark (any store Spark can read)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under ``spark.checkpoint.dir`` and read it back: the
    rows are computed once, lineage ends there, and losing an executor loses nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Eager reliable checkpoint in the shared folder (removed by the context cleaner)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def n_words(text: Column) -> Column:
    """Number of words of a text column (null or blank: 0), without keeping the words."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.length(trimmed) == 0, F.lit(0)).otherwise(F.size(F.split(trimmed, BLANKS))).cast("long")


def record_batch(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    """A record batch of ``schema`` from Arrow arrays and Python lists."""
    return pa.RecordBatch.from_arrays(
        [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
    )


# ---------------------------------------------------------------- word hashes (numpy)

_TABLE = np.random.Generator(np.random.PCG64(20240501)).integers(0, 2**64, 256, dtype=U64)
_R = U64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_RINV = U64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=U64)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: a bijection on 64-bit values that spreads all bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def span_hash(items: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash modulo 2**64 of items[start:end] for many spans at once."""
    n = len(items)
    up = _powers(_R, n + 1)
    acc = np.zeros(n + 1, dtype=U64)
    np.cumsum(items * up[:n], dtype=U64, out=acc[1:])
    return mix64((acc[end] - acc[start]) * _powers(_RINV, n + 1)[start] + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, word starts, word ends) of a UTF-8 text."""
    raw = np.frombuffer(data, dtype=np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _BLANK[raw], [True])).astype(np.int8)))
    return raw, edge[0::2], edge[1::2]


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hash of every word of a UTF-8 text, in order."""
    raw, start, end = word_spans(data)
    if not len(start):
        return np.zeros(0, dtype=U64)
    return span_hash(_TABLE[raw], start, end)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every run of ``k`` consecutive words (by their word hashes)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    start = np.arange(n)
    return span_hash(words, start, start + k)


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's signed long."""
    return x.view(np.int64)


# ---------------------------------------------------------------- connected components


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(u, v)``: ``(node, comp)``, comp = least node.

    Alternating large-star / small-star contraction: each round is two aggregations
    (minimum per node, combined before the shuffle) and two equi-joins that adaptive
    execution can split for hot nodes; the number of edges never grows. Every round is
    checkpointed to the shared folder. Only one number per round reaches the driver.
    """
    cur = checkpointed(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    last = None
    for _ in range(max_rounds):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # the key is passed through an expression so that the joins below shuffle this side by
        # themselves: only then can adaptive execution split a hub's edges on the other side
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").bitwiseXOR(F.lit(0)).alias("u"), F.least("u", "m").alias("m"))
        # large star: every larger neighbour of u is hung on the least of u's neighbourhood
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: u and its smaller neighbours are hung on the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").bitwiseXOR(F.lit(0)).alias("u"), "m")
        small = large.join(low, "u")
        cur = checkpointed(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        )
        state = cur.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == last:
            break
        last = state
    else:
        raise RuntimeError("components did not converge")
    nodes = cur.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return nodes.unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()).groupBy("node").agg(F.min("comp").alias("comp"))
