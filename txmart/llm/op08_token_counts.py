"""Token counts: separator scan over flat, unindexed token files.

A token file is a flat run of fixed-width little-endian ids in which an end-of-document id
closes every document; nothing says where documents begin. It is handled as blocks of
``block_tokens`` ids cut without regard to documents (``file, block, data``). A scan
compares each block with the separator id in one vectorised step and returns its separator
positions; boundaries are stitched across blocks by prefix scans over one row per block:
the number of separators before a block gives document ordinals, the last separator before
it gives where its first document began. Prefix scans run in two levels (blocks within
groups of ``GROUP`` blocks, then groups), so no window sees a whole large file.

``write_token_files`` makes such files from documents (byte-level BPE by default; the
vocabulary is a path parameter, read on the driver and broadcast, its size checked), with a
side table ``file, ordinal, doc_id`` that the scan itself never reads. ``read_token_files``
reads files from outside, each as one value, so up to 2 GiB a file.

Defined cases: null or empty text: a document of no tokens (just its separator); ids after
the last separator: counted as an unfinished document (``closed`` false); a file length that
is no multiple of the width raises; empty table: no rows; repeated rows and null ids are
documents like any other; extra columns are ignored.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txmart.llm.common import materialize, record_batch, register, table, to_arrow_schema

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: fixed value: the splitting pattern of the byte-level BPE vocabulary
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEPARATOR = 50256
#: bytes per id: the vocabulary has fewer than 2**16 ids
WIDTH = 2
KINDS = {2: "<u2", 4: "<u4"}
BLOCK_TOKENS = 1 << 16
#: documents encoded, and blocks compared, at a time: bounds a Python worker's memory
ROWS = 256
BLOCKS_AT_ONCE = 16
GROUP = 512
MAX_VOCABULARY_BYTES = 16 << 20



def load_ranks(path: str) -> bytes:
    """The vocabulary file, with its size checked (it is broadcast)."""
    size = os.path.getsize(path)
    if size > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has {size} bytes; a vocabulary is broadcast only up to {MAX_VOCABULARY_BYTES}")
    with open(path, "rb") as f:
        return f.read()


def encoder(ranks: bytes):
    import tiktoken

    table_of = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("broadcast", pat_str=SPLIT, mergeable_ranks=table_of, special_tokens={})


def write_token_files(docs: DataFrame, vocabulary: str = VOCABULARY, separator: int = SEPARATOR, block_tokens: int = BLOCK_TOKENS, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """(blocks, order): the token files of ``docs``, one per scan task, written to the shared
    folder as blocks, and the side table of which document came where. One pass writes both
    kinds of rows; a lost task is run again whole, before anything of it is visible."""
    shared = docs.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))
    schema = T._parse_datatype_string("file long, block long, data binary, ordinals array<long>, ids array<long>")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, file = encoder(shared.value).encode_ordinary, TaskContext.get().partitionId()
        kind = np.dtype(KINDS[width])
        end, rest, block, ordinal = np.array([separator], dtype=kind), np.zeros(0, dtype=kind), 0, 0
        for b in (x.slice(at, ROWS) for x in batches for at in range(0, len(x), ROWS)):
            ids, pieces = b.column("doc_id").to_pylist(), [rest]
            for text in b.column("text").to_pylist():
                pieces += [np.array(encode(text) if text else [], dtype=kind), end]  # an id that does not fit raises
            flat = np.concatenate(pieces)
            full = len(flat) // block_tokens
            data = [flat[i * block_tokens : (i + 1) * block_tokens].tobytes() for i in range(full)]
            rest = flat[full * block_tokens :]
            yield record_batch(
                [[file] * (full + 1), [*range(block, block + full), None], [*data, None], [[]] * full + [list(range(ordinal, ordinal + len(ids)))], [[]] * full + [ids]], arrow
            )
            block, ordinal = block + full, ordinal + len(ids)
        if len(rest):
            yield record_batch([[file], [block], [rest.tobytes()], [[]], [[]]], arrow)

    made = materialize(docs.select("doc_id", "text").mapInArrow(run, schema), "tokens")
    order = made.where("block is null").select("file", F.explode(F.arrays_zip("ordinals", "ids")).alias("p"))
    return made.where("block is not null").select("file", "block", "data"), order.select("file", F.col("p.ordinals").alias("ordinal"), F.col("p.ids").alias("doc_id"))


def read_token_files(spark: SparkSession, path: str, width: int = WIDTH, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``file`` (its path), ``block``, ``data`` of flat token files (up to 2 GiB each)."""
    step = block_tokens * width
    whole = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")
    count = F.greatest(F.ceil(F.length("content") / step), F.lit(1)) - 1
    cut = whole.select("file", "content", F.explode(F.sequence(F.lit(0).cast("long"), count.cast("long"))).alias("block"))
    return cut.select("file", "block", F.substring("content", (F.col("block") * step + 1).cast("int"), F.lit(step)).alias("data"))


def separators(blocks: DataFrame, separator: int = SEPARATOR, width: int = WIDTH) -> DataFrame:
    """One row per block: ``file, block, tokens`` and ``at``, its separator positions."""
    kind = KINDS[width]
    schema = T.StructType([blocks.schema["file"], T.StructField("block", T.LongType()), T.StructField("tokens", T.LongType()), T.StructField("at", T.ArrayType(T.IntegerType()))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(at, BLOCKS_AT_ONCE) for x in batches for at in range(0, len(x), BLOCKS_AT_ONCE)):
            ids = [np.frombuffer(x or b"", dtype=kind) for x in b.column("data").to_pylist()]
            yield record_batch([b.column("file"), b.column("block"), [len(x) for x in ids], [np.flatnonzero(x == separator).astype(np.int32) for x in ids]], arrow)

    return blocks.select("file", "block", "data").mapInArrow(run, schema)


def token_counts(blocks: DataFrame, separator: int = SEPARATOR, width: int = WIDTH, group: int = GROUP) -> DataFrame:
    """One row per document: ``file, ordinal, n_tokens, closed`` (tokens without separator)."""
    found = materialize(separators(blocks, separator, width).withColumn("part", F.floor(F.col("block") / group)), "separators")
    rows = found.select("file", "part", "block", "tokens", F.size("at").cast("long").alias("n"), F.get("at", F.size("at") - 1).alias("last"))
    inner = Window.partitionBy("file", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("file", "part").agg(
        F.sum("tokens").alias("tokens"), F.sum("n").alias("n"), F.max(F.when(F.col("n") > 0, F.struct("block", "last"))).alias("end")
    )
    # tokens up to a block are those of earlier parts and of earlier blocks of its part
    before = parts.select("file", "part", F.coalesce(F.sum("tokens").over(outer), F.lit(0)).alias("t0"), F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("n0"))
    placed = rows.join(before, ["file", "part"]).select(
        "file", "part", "block", "n", "tokens",
        (F.col("t0") + F.coalesce(F.sum("tokens").over(inner), F.lit(0))).alias("start"), (F.col("n0") + F.coalesce(F.sum("n").over(inner), F.lit(0))).alias("ordinal"),
        "last",
    )
    closing = placed.withColumn("end", F.when(F.col("n") > 0, F.col("start") + F.col("last")))
    carried = closing.groupBy("file", "part").agg(F.max("end").alias("end"))
    carried = carried.select("file", "part", F.max("end").over(outer).alias("end0"))
    opened = closing.join(carried, ["file", "part"]).select(
        "file", "block", "ordinal", "start", "tokens", F.coalesce(F.greatest(F.max("end").over(inner), F.col("end0")), F.lit(-1)).alias("previous"),
        "end",
    )
    spread = opened.join(found.select("file", "block", "at"), ["file", "block"])
    ends = spread.select("file", "ordinal", "previous", "start", F.posexplode("at").alias("i", "pos"), "at")
    earlier = F.when(F.col("i") == 0, F.col("previous")).otherwise(F.col("start") + F.get("at", F.col("i") - 1))
    closed = ends.select("file", (F.col("ordinal") + F.col("i")).alias("ordinal"), (F.col("start") + F.col("pos") - earlier - 1).alias("n_tokens"), F.lit(True).alias("closed"))
    tail = opened.groupBy("file").agg(F.max(F.col("start") + F.col("tokens")).alias("total"), F.max("end").alias("end"))
    total = rows.groupBy("file").agg(F.sum("n").alias("ordinal"))
    open_docs = tail.join(total, "file").select("file", "ordinal", (F.col("total") - 1 - F.coalesce("end", F.lit(-1))).alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.unionByName(open_docs.where("n_tokens > 0"))


@register("op8_token_counts")
def op8_token_counts(spark, sf_dir):
    """Every document, tokenised to flat files and counted from their separators alone."""
    blocks, order = write_token_files(table(spark, sf_dir, "documents"))
    return token_counts(blocks).join(order, ["file", "ordinal"]).select("doc_id", "n_tokens")
