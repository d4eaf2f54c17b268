"""Delivered files (S-1 .. S-5): scan by extension, provenance, validation, profile."""

from __future__ import annotations

import csv
import hashlib
import os
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txmart.operators.clean import missing_profile
from txmart.session import ensure_checkpoint_dir
from txmart.sources.csv_split import DIALECT, places_of, plain_path, read_records, with_provenance

READERS = {".csv": "csv", ".parquet": "parquet", ".json": "json", ".jsonl": "json"}
EXCEL = (".xlsx", ".xls")
FILES_DDL = "path string, source_file_hash string"
#: files up to this length are hashed by their bytes, as one value of one row
WHOLE_BYTES = 64 << 20


class EmptyInput(ValueError):
    """The delivered file(s) hold no rows (S-3)."""


def _extension(path: str) -> str:
    return os.path.splitext(path.rstrip("/"))[1].lower()


def _as_list(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def source_format(paths, fmt: str | None = None) -> str:
    """The reader for delivered paths, by their common extension unless given (S-1)."""
    if fmt is not None:
        return fmt
    exts = {_extension(p) for p in _as_list(paths)}
    if len(exts) != 1:
        raise ValueError(f"Mixed or missing file formats: {sorted(exts)}")
    ext = exts.pop()
    if ext in EXCEL:
        raise ValueError(f"Unsupported file format: {ext} (convert the workbook to CSV or Parquet)")
    if ext not in READERS:
        raise ValueError(f"Unsupported file format: {ext}")
    return READERS[ext]


def list_files(spark: SparkSession, paths) -> list[tuple[str, int]]:
    """(path, length) of every delivered file, the list any scan is planned from (contents
    are pruned from the scan, which leaves out files of no bytes)."""
    listed = spark.read.format("binaryFile").load(_as_list(paths)).select(F.col("_metadata.file_path").alias("path"), "length")
    found = [(r["path"], r["length"]) for r in listed.collect()]
    plain = {plain_path(p) for p, _ in found}
    others = [re.sub("^file:/+", "file:/", p) for p in listed.inputFiles()]  # as rows of the scan name them
    return sorted(found + [(p, 0) for p in others if plain_path(p) not in plain and not _length(spark, p)])


def _length(spark: SparkSession, path: str) -> int:
    file = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(path))
    return file.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(file).getLen()


def csv_header(spark: SparkSession, path: str) -> list[str] | None:
    """Column names of a CSV file: its first record that is not blank, or None. Only that
    much of the file is read, through the file system its path names."""
    jvm = spark._jvm
    file = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
    stream = file.getFileSystem(spark._jsc.hadoopConfiguration()).open(file)
    try:
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        record: list[str] = []
        while (line := lines.readLine()) is not None:
            if record or line.strip():
                record.append(line)
                if not ends_quoted(record):
                    break
    finally:
        stream.close()
    return next(csv.reader(["\n".join(record).removeprefix("\ufeff")])) if record else None


def ends_quoted(lines: list[str]) -> bool:
    """Whether a quoted field is still open at the end of these lines of one record."""
    text, inside, at_start, i = "\n".join(lines), False, True, 0
    while i < len(text):
        c = text[i]
        if inside:
            if c == '"' and text[i + 1 : i + 2] == '"':
                i += 1
            elif c == '"':
                inside = False
        elif c == '"' and at_start:
            inside = True
        at_start = not inside and c == ","
        i += 1
    return inside


def read_source(spark: SparkSession, paths, fmt: str | None = None, multi_line: bool = True) -> DataFrame:
    """S-1: the rows of delivered files, see ``read_delivery``."""
    return read_delivery(spark, paths, fmt, multi_line)[0]


def read_delivery(spark: SparkSession, paths, fmt: str | None = None, multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """S-1: (rows, places) of delivered files by extension, with provenance (S-4).

    CSV: every column as a string (no inference: ids such as ``007`` stay intact), quotes
    doubled inside quoted fields, quoted line breaks if ``multi_line``; blank lines are
    skipped, also before the header; files whose headers differ are read by their own header
    and united by column name, so neither order nor absent columns shift values. A file is
    read by splits however its quotes lie (``sources.csv_split``); ``multi_line=False`` saves
    the pass over the quotes for files known to have no line breaks in fields. A delivery none
    of whose files has a header raises ``EmptyInput``. Parquet and JSON are read as they are. A
    missing path raises Spark's PATH_NOT_FOUND (S-3). Rows carry ``source_file_name``,
    ``_source_file_path``, ``_block`` (where the scanned piece of the file starts) and ``_pos``
    (increasing within it); ``places`` counts them per piece. A file without rows is in
    neither."""
    kind = source_format(paths, fmt)
    if kind != "csv":
        rows = with_provenance(spark.read.format(kind).load(_as_list(paths)))
        return rows, places_of(rows)
    groups: dict[tuple, list[str]] = {}
    for path, _ in list_files(spark, paths):
        header = csv_header(spark, path)
        if header is not None:
            groups.setdefault(tuple(header), []).append(path)
    if not groups:
        raise EmptyInput("the delivered files hold no header line")
    rows = places = None
    for names, files in groups.items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        if multi_line:
            part, at = read_records(spark, files, schema)
        else:
            part = with_provenance(spark.read.schema(schema).options(**DIALECT).option("header", True).csv([plain_path(f) for f in files]))
            at = places_of(part)
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
        places = at if places is None else places.unionByName(at)
    return rows, places


def file_hashes(spark: SparkSession, paths, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """S-4: ``path, source_file_hash`` of each delivered file, one row per file, computed now.

    MD5 of the file's bytes for a file of at most ``whole_bytes``. A larger file gets a digest
    of its lines in order instead, which starts with ``lines:`` (see ``line_digests``). Which
    of the two depends on the file's length alone, on no setting of the session."""
    listed = list_files(spark, paths)
    small, large = ([p for p, n in listed if n and (n > whole_bytes) == big] for big in (False, True))
    empty = [(p, hashlib.md5(b"").hexdigest()) for p, n in listed if not n]
    out = spark.createDataFrame(empty, FILES_DDL)
    limit = "spark.sql.sources.binaryFile.maxLength"
    before = spark.conf.get(limit)
    try:
        if small:
            spark.conf.set(limit, str(max(int(before), whole_bytes)))
            whole = spark.read.format("binaryFile").load([plain_path(p) for p in small])
            out = out.unionByName(whole.select(F.col("_metadata.file_path").alias("path"), F.md5("content").alias("source_file_hash")))
        if large:
            out = out.unionByName(line_digests(spark, large))
        ensure_checkpoint_dir(spark)
        return out.checkpoint(eager=True)
    finally:
        spark.conf.set(limit, before)


def line_digests(spark: SparkSession, paths) -> DataFrame:
    """``path, source_file_hash`` from every line and its number: the MD5 of ``number:line``
    of all lines are added up as two 64-bit halves. A sum takes lines in any order, so no line
    is shuffled, and the numbers in it make the order count. Numbers come from the lines per
    split (one row each), so the size of splits makes no difference."""
    lines = spark.read.option("lineSep", "\n").text([plain_path(p) for p in _as_list(paths)])
    lines = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"), "value")
    splits = lines.groupBy("path", "block").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"))
    before = F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = splits.select("path", "block", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    # as many rows as the scan has splits, which the driver plans one by one
    numbered = lines.join(F.broadcast(offsets), ["path", "block"])
    digest = F.md5(F.concat((F.col("pos") + F.col("shift")).cast("string"), F.lit(":"), "value").cast("binary"))
    half = lambda i: F.sum(F.conv(F.substring(digest, i, 16), 16, 10).cast("decimal(38,0)"))
    sums = numbered.groupBy("path").agg(F.count(F.lit(1)).alias("n"), half(1).alias("a"), half(17).alias("b"))
    return sums.select("path", F.concat(F.lit("lines:"), F.md5(F.concat_ws(":", "n", "a", "b").cast("binary"))).alias("source_file_hash"))


def stamp_hashes(places: DataFrame, hashes: list) -> DataFrame:
    """S-4: the hash of its file on every place (one row per piece of a file); rows get it with
    their number. ``hashes``: (path, hash) pairs, the driver's list of files to read."""
    pairs = places.sparkSession.createDataFrame(hashes, FILES_DDL).withColumnRenamed("path", "_source_file_path")
    return places.join(F.broadcast(pairs), "_source_file_path", "left")


def extraction_profile(df: DataFrame) -> DataFrame:
    """S-5: per column its Spark type, null count and the row count (one aggregate)."""
    types = df.sparkSession.createDataFrame([(c, t) for c, t in df.dtypes], "column_name string, data_type string")
    return missing_profile(df).join(F.broadcast(types), "column_name")
