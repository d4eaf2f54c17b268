"""Query registry: each entry a Spark plan over the given tables plus its DuckDB oracle SQL.

Each query reads the whole driver tables (or data Spark derives from them) and returns a
DataFrame with portable column types: decimals become double, small ints bigint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txmart.sources import tables as tb

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return portable(fn(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return deco


def portable(df: DataFrame) -> DataFrame:
    """Cast decimals to double and 8/16/32-bit ints to bigint (DuckDB's date parts are BIGINT)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _t(spark, sf_dir, name):
    return tb.read_table(spark, sf_dir, name)


