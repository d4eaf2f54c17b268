"""Staging (S-6, S-8, I-2): delivered rows -> ``staging.raw_banking_data``; cleaned rows
-> ``staging.cleaned_banking_data`` insert-if-absent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txmart.operators.conform import conform
from txmart.operators.keys import number_by_place
from txmart.schemas import DELIVERED_FILES
from txmart.settings import CANONICAL_COLUMNS


def new_files(hashes: DataFrame, delivered_files: DataFrame) -> DataFrame:
    """I-2: the delivered files whose hash is not staged yet (a re-delivered file, even
    under another name, is skipped). One row per file on both sides; rows of a skipped file
    are never read. A file that gave no record was not staged."""
    if "error" in delivered_files.columns:
        delivered_files = delivered_files.where("error is null")
    seen = delivered_files.select("source_file_hash").where("source_file_hash is not null").distinct()
    return hashes.join(seen, "source_file_hash", "left_anti").select("path", "source_file_hash")


def delivered_file_rows(hashes: list, rows_of: dict, batch_id: str, now, taken: set, spark) -> DataFrame:
    """One ledger row per delivered file (``hashes``: path, hash; ``rows_of``: rows by path).
    A file that was read and gave no record has an ``error``; it does not count as staged, so
    the same bytes delivered again are judged again."""
    error = lambda path: "no rows" if path in taken and not rows_of.get(path) else None
    files = [(digest, path.rsplit("/", 1)[-1], path, rows_of.get(path, 0), batch_id, now, error(path)) for path, digest in hashes]
    return spark.createDataFrame(files, DELIVERED_FILES)


def raw_payload(cols) -> "F.Column":
    """S-6 ``raw_data``: the row as JSON text, nulls kept (``{"customer_id":"C1","x":null}``)."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"})


def stage_rows(delivered: DataFrame, places: DataFrame, base: DataFrame, now, conform_input: bool = True) -> DataFrame:
    """S-6: conformed rows with provenance, ``raw_data`` JSON, flags and new ids.

    ``delivered`` carries the file's columns plus ``source_file_name``, ``_source_file_path``,
    ``_block`` and ``_pos``; ``places`` has one row per piece of a file with its rows and
    ``source_file_hash`` (see ``sources.files``). Ids follow ``base`` (one row ``_base``) in the
    order of (file path, place in file); rows are numbered where they are read.
    """
    extra = ("source_file_name", "_source_file_path", "_block", "_pos")
    rows = conform(delivered, extra=extra) if conform_input else delivered
    rows = number_by_place(rows, "id", places, base).drop("_source_file_path", "_block", "_pos")
    payload = raw_payload((*CANONICAL_COLUMNS, "source_file_name", "source_file_hash"))
    ts = F.lit(now).cast("timestamp_ntz")
    return rows.withColumns({"raw_data": payload, "is_processed": F.lit(False), "processed_at": F.lit(None).cast("timestamp_ntz"), "created_at": ts})


def persist_cleaned(cleaned_batch: DataFrame, existing: DataFrame) -> DataFrame:
    """S-8: the cleaned rows whose ``source_row_id`` is not yet in the cleaned table."""
    return cleaned_batch.join(existing.select("source_row_id"), "source_row_id", "left_anti")
