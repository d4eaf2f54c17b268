"""The ids that the fact holds (J-5 for D-9), as one of Spark's bucketed tables.

A load must not add a ``transaction_id`` a second time. Asking the fact itself shuffles every
id ever loaded; here they stand in a Parquet table clustered by ``transaction_id``, one
partition per part of the fact, whose files Spark joins bucket by bucket: the batch is
shuffled to the buckets, the history is read where it lies.

The table is derived from the fact and heals itself: parts of the fact that have no ledger
part (a warehouse older than the ledger, rows appended by hand) are added in one job before
the ledger is used, and ledger parts of facts that are gone are not read. A part counts once
a commit marker names it, in the same marker as its facts; every attempt writes a partition of
its own name, so what a failed run wrote is never read. The number of buckets is fixed by
the first load (``buckets``, else the session's shuffle partitions) and is part of the
committed name, so no later setting can misread the files; ``rebuild`` changes it.

The catalog entry is an external table over the ledger's folder. It lists exactly the visible
parts and is put right whenever the ledger is used, so any session may create it anew.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txmart.operators.states import part_of
from txmart.sources.warehouse import Change, Warehouse

LEDGER = "mart.fact_ids"


class IdLedger:
    def __init__(self, wh: Warehouse, fact: str = "mart.fact_transactions", buckets: int | None = None):
        self.wh = wh
        self.spark = wh.spark
        self.fact = fact
        self.version = wh.current_version(LEDGER) or 1
        named = [p.split("-") for p in wh.parts(LEDGER)]  # buckets, part of the fact, attempt
        self._covered = {part: f"{part}-{attempt}" for _, part, attempt in named}
        self.buckets = int(named[0][0]) if named else buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _location(self) -> str:
        return self.wh.version_path(LEDGER, self.version)

    def _table(self, parts) -> str:
        """The catalog's table over the ledger's folder, listing exactly the partitions of these
        parts of the fact, as far as they are covered."""
        wanted = {self._covered[p] for p in parts if p in self._covered}
        where = self._location()
        name = f"txmart_fact_ids_{hashlib.md5(where.encode()).hexdigest()[:16]}"
        if not self.spark.catalog.tableExists(name):
            path = where.replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(f"create table {name} (transaction_id string, part string) using parquet partitioned by (part) "
                           f"clustered by (transaction_id) into {self.buckets} buckets location '{path}'")
        listed = {r[0].split("=", 1)[1] for r in self.spark.sql(f"show partitions {name}").collect()}
        for verb, names in (("add", wanted - listed), ("drop", listed - wanted)):
            if names:
                sep = " " if verb == "add" else ", "
                self.spark.sql(f"alter table {name} {verb} {sep.join(f"partition (part='{p}')" for p in sorted(names))}")
        return name

    def cover(self, *pending: Change) -> list[Change]:
        """Write the ids of those parts of the fact (committed, and ``pending``) that the ledger
        lacks, in one job however many they are; the changes to commit."""
        parts = self.wh.parts(self.fact, *pending)
        missing = [p for p in parts if p not in self._covered]
        if not missing:
            return []
        attempt = uuid.uuid4().hex
        part = part_of(F.col("_metadata.file_path"))
        ids = self.wh.read_parts(self.fact, missing, *pending).select("transaction_id", F.concat_ws("-", part, F.lit(attempt)).alias("part"))
        ids.repartition(self.buckets, "transaction_id").write.insertInto(self._table(parts))
        self._covered |= {p: f"{p}-{attempt}" for p in missing}
        return [Change(LEDGER, self.version, f"{self.buckets}-{self._covered[p]}") for p in missing]

    def ids(self) -> DataFrame:
        """``transaction_id`` of every committed fact, clustered into ``buckets`` buckets. Parts
        that are missing are written and committed first."""
        self.wh.commit(*self.cover())
        return self.spark.table(self._table(self.wh.parts(self.fact))).select("transaction_id")

    def rebuild(self, buckets: int) -> None:
        """Write the ledger anew with another number of buckets."""
        self.version += 1
        self.buckets, self._covered = buckets, {}
        self.wh.commit(*self.cover())
