"""CSV files read by many tasks although quoted fields hold line breaks (S-1).

Whether a line break ends a record depends on all quotes before it. A line is therefore a
function of the state it begins in (0: outside, 1: inside a quoted field): what state it ends
in. Such functions compose, and a prefix of them is known from two sums: a line that ends
in the same state whatever it began in is an *anchor*, any other either keeps or turns the
state. So the state after a line is that of the last anchor, turned as often as lines have
turned it since.

A first pass counts per split the lines that, begun outside, end inside, and the blank ones
(one row a split, nothing else moves). A file without either has one record a line: its
lines are numbered and parsed where they are read. For the other files the lines of each piece
of a split are put in order (so the memory of a task does not grow with the split), every piece
is summed up to one row (its function and how many records it starts under either state), a
prefix over these rows gives each piece its state and its first record number, and the lines are numbered; only those of a record of several lines are
grouped by its number.

A quote opens a field only at its start, as in the one-task reader; blank lines between
records are skipped; the first record of a file is its header. A file that ends inside a
quoted field raises ``OpenQuote``: its last record never ends.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txmart.session import ensure_checkpoint_dir

#: how delivered files quote: a quote inside a quoted field is doubled
DIALECT = {"quote": '"', "escape": '"'}

#: lines are put in order in pieces of a split: of at most 2**16 lines, numbered within its task
PIECE, PIECE_BITS = ["path", "block", "chunk"], 16

#: states while the pieces between the quotes of a line are read
OUTSIDE, INSIDE, CLOSING, RECORD_START = range(4)


class OpenQuote(ValueError):
    """A file ends inside a quoted field."""


def with_provenance(df: DataFrame) -> DataFrame:
    """S-4 (part): each row's file name (base name, like the source system), path and place."""
    return df.withColumns(
        {
            "source_file_name": F.substring_index(F.col("_metadata.file_path"), "/", -1),
            "_source_file_path": F.col("_metadata.file_path"),
            "_block": F.col("_metadata.file_block_start"),
            "_pos": F.monotonically_increasing_id(),
        }
    )


def state_after(value: Column, begin: int) -> Column:
    """Whether a line that begins in a state ends inside a quoted field (1) or not (0). A quote
    opens a field after a comma or at the record's start; inside, it closes the field unless
    the next one follows at once; any other quote is text."""
    pieces = F.split(value, '"', -1)

    def step(state: Column, piece: Column) -> Column:
        opens = F.endswith(piece, F.lit(",")) | ((piece == "") & (state == RECORD_START))
        return (
            F.when(state == INSIDE, F.lit(CLOSING))
            .when((state == CLOSING) & (piece == ""), F.lit(INSIDE))
            .when(opens, F.lit(INSIDE))
            .otherwise(F.lit(OUTSIDE))
        )

    # the piece after the last quote meets no quote
    before_quotes = F.slice(pieces, 1, F.size(pieces) - 1)
    return (F.aggregate(before_quotes, F.lit(begin), step) == INSIDE).cast("int")


def plain_path(uri: str) -> str:
    """The path that readers take, of the URI that rows carry (``%20`` for a blank)."""
    return unquote(uri)


def text_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """``path, block, pos, value`` of every line."""
    return spark.read.option("lineSep", "\n").text([plain_path(f) for f in files]).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"), "value"
    )


def quoted_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """Lines with their place and function: ``from_out`` and ``from_in`` are the states they
    end in. A line without a quote keeps any state."""
    lines = text_lines(spark, files)
    quotes = F.col("value").contains('"')
    return lines.withColumns(
        {
            "from_out": F.when(quotes, state_after(F.col("value"), RECORD_START)).otherwise(0),
            "from_in": F.when(quotes, state_after(F.col("value"), INSIDE)).otherwise(1),
            "blank": F.ltrim("value", F.lit(" \r\t")) == "",
        }
    )


def compose(rows: DataFrame, part: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``out`` and ``in`` of the composition of all functions up to each row:
    the state after it when the first row of its part begins outside or inside."""
    upto = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    anchor, turn = F.col("from_out") == F.col("from_in"), (F.col("from_out") == 1) & (F.col("from_in") == 0)
    rows = rows.withColumn("_turns", F.sum(turn.cast("int")).over(upto))
    rows = rows.withColumn("_anchor", F.last(F.when(anchor, F.struct(F.col("from_out").alias("state"), F.col("_turns").alias("turns"))), ignorenulls=True).over(upto))
    since = F.col("_turns") - F.coalesce("_anchor.turns", F.lit(0))
    after = lambda start: ((F.coalesce("_anchor.state", F.lit(start)) + since) % 2).cast("int")
    return rows.withColumns({"out": after(0), "in": after(1)}).drop("_turns", "_anchor")


def _before(rows: DataFrame, part: list[str], order: list[str]) -> DataFrame:
    """The states before each row under either start."""
    w = Window.partitionBy(*part).orderBy(*order)
    return rows.withColumns({"out0": F.coalesce(F.lag("out").over(w), F.lit(0)), "in0": F.coalesce(F.lag("in").over(w), F.lit(1))})


def starts(state: str) -> Column:
    """Whether a record begins at a line that is reached in ``state``."""
    return ((F.col(state) == 0) & ~F.col("blank")).cast("long")


def split_table(lines: DataFrame) -> DataFrame:
    """One row per piece of a split: ``path, block, chunk, state`` it begins in, ``records`` begun
    before it, ``upto`` (records begun up to its end) and ``ends`` (the state after it)."""
    placed = _before(compose(lines.drop("value"), PIECE, ["pos"]), PIECE, ["pos"])
    pieces = placed.groupBy(*PIECE).agg(
        F.max_by("out", "pos").alias("from_out"), F.max_by("in", "pos").alias("from_in"), F.sum(starts("out0")).alias("n_out"), F.sum(starts("in0")).alias("n_in")
    )
    # from here on one row per piece, however long the files are
    at = ["block", "chunk"]
    ordered = _before(compose(pieces, ["path"], at), ["path"], at)
    begun = F.when(F.col("out0") == 0, F.col("n_out")).otherwise(F.col("n_in"))
    earlier = F.sum(begun).over(Window.partitionBy("path").orderBy(*at).rowsBetween(Window.unboundedPreceding, -1))
    ordered = ordered.withColumns({"begun": begun, "records": F.coalesce(earlier, F.lit(0))})
    return ordered.select(*PIECE, F.col("out0").alias("state"), "records", (F.col("records") + F.col("begun")).alias("upto"), F.col("out").alias("ends"))


def ordered_records(spark: SparkSession, files: list[str]) -> tuple[DataFrame, DataFrame]:
    """As ``records``, for files whose records may have several lines. Raises ``OpenQuote`` for a file
    whose last record does not end."""
    lines = quoted_lines(spark, files).withColumn("chunk", F.shiftright(F.col("pos").bitwiseAND((1 << 33) - 1), PIECE_BITS))
    splits = split_table(lines).checkpoint(eager=True)
    ends = splits.groupBy("path").agg(F.max_by("ends", F.struct("block", "chunk")).alias("ends")).where("ends = 1").orderBy("path").limit(10).collect()
    if ends:
        raise OpenQuote(f"a quoted field never ends in {[r['path'] for r in ends]}")
    placed = _before(compose(lines, PIECE, ["pos"]), PIECE, ["pos"])
    # one row per piece, some thousand lines each
    placed = placed.join(F.broadcast(splits.select(*PIECE, "state", "records")), PIECE)
    pick = lambda out, inside: F.when(F.col("state") == 0, F.col(out)).otherwise(F.col(inside))
    placed = placed.withColumns({"before": pick("out0", "in0"), "after": pick("out", "in")})
    upto = Window.partitionBy(*PIECE).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("record", F.col("records") + F.sum(starts("before")).over(upto))
    placed = placed.where("record > 1").where((F.col("before") == 1) | ~F.col("blank"))
    counts = splits.groupBy("path").agg((F.max("upto") - 1).alias("records"))
    one_line = (F.col("before") == 0) & (F.col("after") == 0)
    single = placed.where(one_line).select("path", "record", "value")
    # the lines of one record; a record is parsed as one value, so it fits a task anyway
    pieces = placed.where(~one_line).groupBy("path", "record").agg(F.sort_array(F.collect_list(F.struct("block", "pos", "value"))).alias("lines"))
    longer = pieces.select("path", "record", F.array_join("lines.value", "\n").alias("value"))
    return single.unionByName(longer).select("path", "record", F.regexp_replace("value", "\r$", "").alias("text")), counts


def line_records(spark: SparkSession, files: list[str], splits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``records``, for files of one record a line; ``splits`` has one row per split with
    its lines and their first position."""
    before = F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    shift = F.coalesce(before, F.lit(0)) - F.col("first") + 1
    # as many rows as the scan has splits, which the driver plans one by one
    placed = text_lines(spark, files).join(F.broadcast(splits.select("path", "block", shift.alias("shift"))), ["path", "block"])
    found = placed.select("path", (F.col("pos") + F.col("shift")).alias("record"), F.regexp_replace("value", "\r$", "").alias("text")).where("record > 1")
    return found, splits.groupBy("path").agg((F.sum("n") - 1).alias("records"))


def counted_splits(spark: SparkSession, files: list[str]) -> DataFrame:
    """One row per split: its lines ``n``, the ``first`` position and how many lines are
    ``odd``: begun outside, they end inside a quoted field, or they are blank."""
    ensure_checkpoint_dir(spark)
    odd = ((F.col("from_out") == 1) | F.col("blank")).cast("long")
    splits = quoted_lines(spark, files).groupBy("path", "block").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"), F.sum(odd).alias("odd"))
    return splits.checkpoint(eager=True)


def records(spark: SparkSession, files: list[str]) -> tuple[DataFrame, DataFrame]:
    """``path, record, text`` of every record but the headers (number 1), and ``path, records``
    (how many these are)."""
    splits = counted_splits(spark, files)
    odd = {r["path"] for r in splits.groupBy("path").agg(F.sum("odd").alias("odd")).where("odd > 0").collect()}  # paths that the driver holds anyway
    parts = []
    if plain := [f for f in files if f not in odd]:
        # positions hold within one list of files only, so a part of the files is counted again
        parts.append(line_records(spark, plain, counted_splits(spark, plain) if odd else splits))
    if odd:
        parts.append(ordered_records(spark, [f for f in files if f in odd]))
    found, counts = parts[0]
    for more, n in parts[1:]:
        found, counts = found.unionByName(more), counts.unionByName(n)
    return found, counts


def read_records(spark: SparkSession, files: list[str], schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, places) of CSV files with one header, read by splits. Rows carry provenance as in
    ``with_provenance``; a file is one piece here (``_block`` 0) and ``_pos`` numbers its
    records from 0. ``places``: see ``places_of``."""
    ddl = ", ".join("`" + f.name.replace("`", "``") + "` string" for f in schema)
    found, counts = records(spark, files)
    # a generator is evaluated once a row; fields taken out of the struct would each parse it again
    parsed = found.select("path", "record", F.inline(F.array(F.from_csv("text", ddl, DIALECT))).alias(*[f"_{i}" for i in range(len(schema))]))
    rows = parsed.select(
        *[F.col(f"_{i}").alias(n) for i, n in enumerate(schema.names)],
        F.substring_index("path", "/", -1).alias("source_file_name"), F.col("path").alias("_source_file_path"), F.lit(0).cast("long").alias("_block"), (F.col("record") - 2).alias("_pos"),
    )
    zero = F.lit(0).cast("long")
    return rows, counts.select(F.col("path").alias("_source_file_path"), zero.alias("_block"), "records", zero.alias("first"))


def places_of(rows: DataFrame) -> DataFrame:
    """``_source_file_path, _block, records, first``: how many rows each scanned piece of a file
    has and their first ``_pos`` (a pass over the places alone)."""
    return rows.groupBy("_source_file_path", "_block").agg(F.count(F.lit(1)).alias("records"), F.min("_pos").alias("first"))

