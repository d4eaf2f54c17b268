"""The mart's tables as versioned Parquet folders (S-13 .. S-16).

Layout: ``{root}/{layer}/{table}/v000000001/{part}/`` holds rows of a table version; a part
counts once a commit marker in ``{root}/_commits/`` names it. One marker is one small file
and may name parts of several tables, so a step that writes many tables becomes visible as
a whole or not at all, also on a store without atomic folder renames. Replacing a table
writes a part of the next version; appending adds a part to the current one. All I/O goes
through Spark, so the root may be any shared file system the cluster can reach. One writer
at a time.
"""

from __future__ import annotations

import threading
import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmart import schemas


class Change(NamedTuple):
    """A part that is written but not committed yet."""

    table: str
    version: int
    part: str


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._state: dict[str, tuple[int, list[str]]] | None = None
        self._lock = threading.Lock()

    # -------------------------------------------------------------- layout
    def version_path(self, table: str, version: int) -> str:
        layer, name = table.split(".", 1)
        return f"{self.root}/{layer}/{name}/v{version:09d}"

    def _part_path(self, change: Change) -> str:
        return f"{self.version_path(change.table, change.version)}/{change.part}"

    def _load(self) -> dict[str, tuple[int, list[str]]]:
        """Table -> (latest version, its committed parts), from all markers in one small job
        (one row per committed part of a run). No markers folder means no warehouse yet; any
        other error is raised."""
        with self._lock:
            if self._state is None:
                state: dict[str, tuple[int, list[str]]] = {}
                try:
                    rows = self.spark.read.schema("table string, version long, part string").json(f"{self.root}/_commits/*").distinct().collect()
                except AnalysisException as e:
                    if e.getCondition() != "PATH_NOT_FOUND":
                        raise
                    rows = []
                for r in sorted(rows):
                    version, parts = state.get(r["table"], (0, []))
                    state[r["table"]] = (version, [*parts, r["part"]]) if r["version"] == version else (r["version"], [r["part"]])
                self._state = state
            return self._state

    def current_version(self, table: str) -> int | None:
        return self._load().get(table, (None, []))[0]

    # -------------------------------------------------------------- S-14 / S-15 / S-13
    def exists(self, table: str) -> bool:
        return self.current_version(table) is not None

    def health_check(self, tables=None) -> bool:
        """S-14: every required table has a committed version."""
        need = tables or ("staging.raw_banking_data", "staging.cleaned_banking_data", "mart.fact_transactions",
                          "mart.dim_customers", "audit.data_quality_metrics")
        return all(self.exists(t) for t in need)

    def row_count(self, table: str) -> int:
        """S-15: rows of a table, -1 when it cannot be read."""
        try:
            return self.read(table).count() if self.exists(table) else -1
        except Exception:  # noqa: BLE001 - the contract is -1 on any error
            return -1

    def initialize(self, seeds: dict[str, DataFrame] | None = None) -> None:
        """S-13: the seed rows of every seeded table that does not exist yet, in one commit;
        idempotent. Tables without a version read as empty with their schema."""
        self.commit(*[self.write(t, df, replace=True) for t, df in (seeds or {}).items() if not self.exists(t)])

    # -------------------------------------------------------------- read / write
    def read(self, table: str, *pending: Change) -> DataFrame:
        """The committed rows of a table, with uncommitted ``pending`` changes applied."""
        parts = self.parts(table, *pending)
        return self.read_parts(table, parts, *pending) if parts else self.spark.createDataFrame([], schemas.TABLES[table])

    def parts(self, table: str, *pending: Change) -> list[str]:
        """Names of the parts that :meth:`read` reads (a run adds one to each table)."""
        version, parts = self._load().get(table, (None, []))
        for c in pending:
            if c.table == table:
                version, parts = c.version, [c.part] if c.version != version else [*parts, c.part]
        return list(parts)

    def read_parts(self, table: str, parts, *pending: Change) -> DataFrame:
        """The rows of some parts of what :meth:`read` reads."""
        version = max([self.current_version(table) or 0, *[c.version for c in pending if c.table == table]])
        folder = self.version_path(table, version)
        return self.spark.read.schema(schemas.TABLES[table]).parquet(*[f"{folder}/{p}" for p in parts])

    def write(self, table: str, df: DataFrame, replace: bool = False) -> Change:
        """Write ``df`` as a part of the current (or, with ``replace``, the next) version. It
        is invisible until committed; a part whose step fails is never read."""
        version = self.current_version(table)
        change = Change(table, (version or 0) + 1 if replace or version is None else version, uuid.uuid4().hex)
        schema = schemas.TABLES[table]
        df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]).write.mode("errorifexists").parquet(self._part_path(change))
        return change

    def commit(self, *changes: Change) -> None:
        """Make the changes visible together: one marker file."""
        if not changes:
            return
        state = self._load()
        rows = self.spark.createDataFrame([tuple(c) for c in changes], "table string, version long, part string")
        rows.coalesce(1).write.mode("errorifexists").json(f"{self.root}/_commits/{uuid.uuid4().hex}")
        for c in changes:
            version, parts = state.get(c.table, (0, []))
            state[c.table] = (version, [*parts, c.part]) if c.version == version else (c.version, [c.part])

    def replace(self, table: str, df: DataFrame) -> None:
        """Write ``df`` as the next version and commit it."""
        self.commit(self.write(table, df, replace=True))

    def append(self, table: str, df: DataFrame) -> None:
        """Add ``df``'s rows to the current version and commit them."""
        self.commit(self.write(table, df))

    def drop_old_versions(self, table: str) -> None:
        """Delete the folders of versions before the current one (no reader may use them)."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for version in range(1, self.current_version(table) or 1):
            path = jvm.org.apache.hadoop.fs.Path(self.version_path(table, version))
            path.getFileSystem(conf).delete(path, True)

    # -------------------------------------------------------------- S-16
    def register_views(self, prefix: str = "") -> None:
        """Expose every committed table as a temp view ``{layer}_{table}``."""
        for table in schemas.TABLES:
            if self.exists(table):
                self.read(table).createOrReplaceTempView(prefix + table.replace(".", "_"))

    def sql(self, query: str, **args) -> DataFrame:
        """S-16: free SQL over the mart (views registered first; ``args`` bind parameters)."""
        self.register_views()
        return self.spark.sql(query, args=args or None)
