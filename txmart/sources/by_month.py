"""The facts a second time, in Parquet folders by month (A-3, G-5): a report over some days
reads the files of their months and no other.

Layout: ``{root}/mart/fact_by_month/month=yyyy-MM-01/part=.../``. It is derived from the fact:
``cover`` adds the parts of the fact that it lacks, which is last night's part on a usual day,
and commits their names with the warehouse's markers. A part never changes, and Spark
overwrites exactly its own folders (dynamic partition overwrite), so a job that fails, or is
run twice, leaves nothing behind and nothing doubled; folders without a marker, or of parts
that the fact no longer has, are not read. Rows are dealt by ``rebalance``: a few files per
month and part, a month that holds a third of a part in as many as its size needs.

Facts without a date lie in a folder of their own and belong to no day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txmart import schemas
from txmart.sources.warehouse import Change, Warehouse

BY_MONTH = "mart.fact_by_month"


class FactByMonth:
    def __init__(self, wh: Warehouse, fact: str = "mart.fact_transactions"):
        self.wh = wh
        self.fact = fact
        self.path = f"{wh.root}/{BY_MONTH.replace('.', '/')}"

    def cover(self) -> list[str]:
        """Lay out the committed parts of the fact that are not yet, in one job; their names."""
        done = set(self.wh.parts(BY_MONTH))
        missing = [p for p in self.wh.parts(self.fact) if p not in done]
        if missing:
            part = F.regexp_extract(F.col("_metadata.file_path"), "/([^/]+)/[^/]+$", 1).alias("part")
            rows = self.wh.read_parts(self.fact, missing).select("*", F.trunc("transaction_date", "month").alias("month"), part)
            (rows.hint("rebalance", "month", "part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("month", "part").parquet(self.path))
            self.wh.commit(*[Change(BY_MONTH, 1, p) for p in missing])
        return missing

    def read(self) -> DataFrame:
        """The facts that are laid out, with their ``month``."""
        done = set(self.wh.parts(BY_MONTH))
        parts = [p for p in self.wh.parts(self.fact) if p in done]
        schema = T.StructType([*schemas.TABLES[self.fact].fields, T.StructField("month", T.DateType()), T.StructField("part", T.StringType())])
        if not parts:
            return self.wh.spark.createDataFrame([], schema).drop("part")
        return self.wh.spark.read.schema(schema).parquet(self.path).where(F.col("part").isin(parts)).drop("part")

    def of(self, days: DataFrame) -> DataFrame:
        """The facts of the calendar days in ``days`` (rows of ``dim_time``; repeated days count
        once). The months are pruned while the query runs, from the broadcast list of days,
        which is bounded by its type: at most 3,652,059 dates are valid, 8 bytes each."""
        listed = days.select(F.trunc("date", "month").alias("month"), F.col("date").alias("transaction_date")).distinct()
        facts = self.read()
        return facts.join(F.broadcast(listed), ["month", "transaction_date"]).select(*[c for c in facts.columns if c != "month"])
