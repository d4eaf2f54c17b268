"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark windows.

Normalisation lower-cases A-Z and keeps runs of digits, letters a-z and non-ASCII
characters as words. Every ``window`` consecutive words of a benchmark item (a shorter
item as a whole) become one pattern `` w1 w2 ... `` with a blank on either side. Each
document is normalised the same way and scanned once; a match at an offset of the
normalised text is mapped to word numbers and from there to offsets of the original.

The automaton is compiled once per Python worker from a broadcast pattern list. A
benchmark is small by nature; its size is measured first and more than
``max_benchmark_chars`` raises instead of broadcasting. Documents are never shuffled:
one map over the scan, memory bounded by the automaton and one Arrow batch.

Defined cases: null or empty text: no words, nothing hit; item with no words: no window;
items with equal windows: each is listed; rows of one item_id: one item; null item_id:
its windows hit words, but it is neither counted nor listed; extra columns of either
table are ignored; repeated document rows give repeated result rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txmart.llm.common import record_batch, register, table, to_arrow_schema

MAX_BENCHMARK_CHARS = 32 << 20

#: bytes to themselves, A-Z to a-z, any other ASCII byte to a blank
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
_RUN = re.compile(rb"[^\x20]+")

FOUND = "n_words long, n_hit long, n_items long, items string, spans array<array<long>>"


def normal_words(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def windows(items: Iterable[tuple], window: int) -> dict[str, tuple[int, set]]:
    """Pattern -> (number of words, items that have it)."""
    out: dict[str, tuple[int, set]] = {}
    for item, text in items:
        words = normal_words(text)
        if not words:
            continue
        size = min(window, len(words))
        for i in range(len(words) - size + 1):
            key = (b" " + b" ".join(words[i : i + size]) + b" ").decode("latin-1")
            out.setdefault(key, (size, set()))[1].add(item)
    return out


def automaton(patterns: dict[str, tuple[int, set]]):
    """Aho-Corasick automaton over the patterns (None when there are none)."""
    if not patterns:
        return None
    found = ahocorasick.Automaton()
    for key, value in patterns.items():
        found.add_word(key, value)
    found.make_automaton()
    return found


def scan_text(auto, text: str | None, with_spans: bool) -> tuple[int, int, list[str], list[list[int]] | None]:
    """(words, hit words, ids of items found, [start, end) spans in the original text)."""
    words = normal_words(text)
    if auto is None or not words:
        return len(words), 0, [], None
    joined = (b" " + b" ".join(words) + b" ").decode("latin-1")
    ends, sizes, items = [], [], set()
    for end, (size, who) in auto.iter(joined):
        ends.append(end)
        sizes.append(size)
        items |= who
    if not ends:
        return len(words), 0, [], None
    # the blank that ends a pattern follows its last word: word number by that blank's place
    blank_after = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    last = np.searchsorted(blank_after, np.array(ends))
    step = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(step, last - np.array(sizes) + 1, 1)
    np.add.at(step, last + 1, -1)
    hit = np.cumsum(step[:-1]) > 0
    spans = _original_spans(text, hit) if with_spans else None
    return len(words), int(hit.sum()), sorted(str(i) for i in items if i is not None), spans


def _original_spans(text: str, hit: np.ndarray) -> list[list[int]]:
    """Code-point spans of the original text that runs of hit words cover."""
    data = text.encode("utf-8", "surrogatepass")
    where = [m.span() for m in _RUN.finditer(data.translate(_FOLD))]
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    point = np.cumsum((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)  # code points up to each byte
    out = []
    for a, b in zip(edge[0::2], edge[1::2]):
        first, last = where[a][0], where[b - 1][1]
        out.append([int(point[first]) - 1, int(point[last - 1])])
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_benchmark_chars: int = MAX_BENCHMARK_CHARS, with_spans: bool = True) -> DataFrame:
    """One row per document: ``doc`` (its row, as a struct, so no column name can clash),
    ``n_words, n_hit, n_items, items`` (ids sorted as strings, comma-joined) and ``spans``
    of the original text."""
    spark = docs.sparkSession
    bench = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null").distinct()
    chars = bench.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    if chars > max_benchmark_chars:
        raise ValueError(f"the benchmark has {chars} characters; the automaton is broadcast only up to {max_benchmark_chars}")
    shared = spark.sparkContext.broadcast([(r.item_id, r.text) for r in bench.collect()])
    picked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    schema = T.StructType(picked.schema.fields + T._parse_datatype_string(FOUND).fields)
    arrow = to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton(windows(shared.value, window))
        for batch in batches:
            rows = [scan_text(auto, t, with_spans) for t in batch.column(0).field("text").to_pylist()]
            cols = [[r[0] for r in rows], [r[1] for r in rows], [len(r[2]) for r in rows], [",".join(r[2]) for r in rows], [r[3] or [] for r in rows]]
            yield record_batch([batch.column(0), *cols], arrow)

    return picked.mapInArrow(scan, schema)


ORACLE = r"""
with dw as (
  select row_number() over () as rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
iw as (
  select cast(item_id as varchar) as item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
win as (
  select distinct item_id, least(len(w), 10) as size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') as win
  from (select item_id, w, unnest(range(1, greatest(len(w) - least(len(w), 10), 0) + 2)) as i from iw where len(w) > 0)),
sizes as (select distinct size from win),
dwin as (
  select rid, i, size, array_to_string(w[i : i + size - 1], ' ') as win
  from (select rid, w, size, unnest(range(1, len(w) - size + 2)) as i from dw, sizes where len(w) >= size)),
hit as (select d.rid, d.i, d.size, win.item_id from dwin d join win on d.win = win.win and d.size = win.size),
cover as (select rid, count(distinct i + k) as n_hit from (select rid, i, unnest(range(0, size)) as k from hit) group by rid),
items as (
  select rid, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items
  from (select distinct rid, item_id from hit) group by rid)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from dw left join cover using (rid) left join items using (rid)
"""


@register("op6_benchmark_decontamination", ORACLE)
def op6_benchmark_decontamination(spark, sf_dir):
    """Every document against every benchmark item, windows of 10 words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc.doc_id", "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))

