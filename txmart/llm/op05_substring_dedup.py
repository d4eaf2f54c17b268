"""Substring dedup: repeated-phrase automata over sharded documents.

A word goes when a window of ``WINDOW`` words around it also starts earlier (smaller id, or
same document and earlier start). Four steps, none of which holds more than a shard:

1. *Anchors.* Of every window the ``PHRASE`` consecutive words with the least hash are its
   anchor: equal windows have equal anchors, and neighbouring windows share theirs, so about
   one word in nine starts one. Anchors seen twice or more anywhere are the recurring
   phrases (counted with map-side combine); a join returns them to the shards they occur in.
2. *Automata.* Documents are dealt to shards of about ``SHARD_BYTES`` by a hash of their
   identity. Each shard compiles an Aho-Corasick automaton of the recurring phrases that
   occur in it and streams its documents through it, which locates every occurrence. Windows
   around an occurrence that anchor there are the candidates: one row per run of them and
   distinct content leaves the shard (later equal runs of the same shard are repeats, and
   leave as joined ranges that need no confirmation). Runs of a hot anchor (over ``HOT``
   occurrences in all) leave as single windows instead, the first of each hash in the shard.
3. *Confirmation.* Candidate rows meet by anchor, windows of hot anchors by their own hash: equal
   windows share their anchor, so all of a hash meet either way. Of every window hash the first occurrence,
   in order of document and place, is kept, and ranges of the others go back.
4. *Removal.* The shard's documents (the same shuffle files are read again) drop the words
   that those ranges cover.

Work and traffic are linear in the words; an automaton holds only what occurs in its own
shard. A phrase that a third of all documents share sends one row per shard and window hash,
not one per document, and those hashes are spread over the buckets. Window hashes have 64 bits, anchors are matched as text.

Defined cases: null or short texts keep all their words; null ids come last, ordered by text
hash; rows that share an id but not the text are ordered by text hash; rows repeated in full
are one document, and each gets its result; empty table: no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txmart.llm.common import U64, gram_hashes, mix64, record_batch, register, signed, span_hash, table, to_arrow_schema, word_hashes, word_spans

WINDOW = 20
PHRASE = 5
SHARD_BYTES = 1 << 20
HOT = 10_000


class Words:
    """The words of many texts in one row: hashes, and the text each word belongs to. Numpy
    works on all texts of a shard at once; windows never reach across texts."""

    def __init__(self, texts: list[str | None]):
        parts = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
        data = b"\n".join(parts)
        self.words = data.split()
        self.hashes = word_hashes(data)
        begins = np.cumsum([0] + [len(x) + 1 for x in parts])
        self.text_of = np.searchsorted(begins, word_spans(data)[1], "right") - 1
        self.edges = np.searchsorted(self.text_of, np.arange(len(parts) + 1))  # first word of each text

    def runs(self, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Runs of consecutive windows with one anchor: (anchor hash, anchor place, first
        window, end window). A window's anchor is its leftmost least phrase hash."""
        n = len(self.hashes) - window + 1
        none = np.zeros(0, dtype=np.int64)
        if n <= 0:
            return np.zeros(0, dtype=U64), none, none, none
        grams = gram_hashes(self.hashes, phrase)
        place = _least_place(grams, window - phrase + 1)
        inside = self.text_of[:n] == self.text_of[window - 1 :]
        cut = np.concatenate(([True], (np.diff(place) != 0) | (self.text_of[1:n] != self.text_of[: n - 1])))
        first = np.flatnonzero(cut)
        end = np.concatenate((first[1:], [n]))
        # windows that start in a text but end in the next are its last ones: cut them off
        end = np.minimum(end, self.edges[self.text_of[first] + 1] - window + 1)
        keep = inside[first] & (end > first)
        first, end = first[keep], end[keep]
        return grams[place[first]], place[first], first, end


def _least_place(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least value of every ``width`` consecutive ones, by doubling."""
    place, have = np.arange(len(values)), 1

    def join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(values[left] <= values[right], left, right)

    while have * 2 <= width:
        place, have = join(place[: len(place) - have], place[have:]), have * 2
    gap = width - have
    return join(place[: len(place) - gap], place[gap:]) if gap else place


def _sharded(docs: DataFrame, shard_bytes: int) -> tuple[DataFrame, int]:
    th = F.xxhash64(F.coalesce("text", F.lit("")))
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_bytes))
    keyed = docs.select(F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id"), th).cast("long").alias("rid"), th.alias("th"), "text")
    return keyed.withColumn("shard", F.pmod(F.xxhash64("rid", "th"), F.lit(shards))), shards


def recurring_phrases(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """``shard, anchor, n`` of anchors that occur twice or more (``n`` times) in all documents
    together."""
    schema = T._parse_datatype_string("anchor long, shard long, times int")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        for b in batches:
            for at in range(0, len(b), 500):
                part = b.slice(at, 500)
                words = Words(part.column("text").to_pylist())
                anchor, place, _, _ = words.runs(window, phrase)
                place, spots = np.unique(place, return_index=True)
                shard = part.column("shard").to_numpy()[words.text_of[place]]
                order = np.lexsort((shard, anchor[spots]))
                anchor, shard = anchor[spots][order], shard[order]
                new = np.flatnonzero(np.concatenate(([True], (np.diff(anchor) != 0) | (np.diff(shard) != 0)))) if len(anchor) else np.zeros(0, dtype=np.int64)
                times = np.diff(np.concatenate((new, [len(anchor)])))
                yield record_batch([pa.array(signed(anchor[new])), pa.array(shard[new]), pa.array(times)], arrow)

    seen = docs.select("shard", "text").mapInArrow(emit, schema)
    often = seen.groupBy("anchor").agg(F.sum("times").alias("n")).where("n > 1")
    return seen.select("anchor", "shard").join(often, "anchor").select("shard", "anchor", "n")


def locate(words: list[bytes], phrases: list[bytes], size: int) -> np.ndarray:
    """First-word places of every occurrence of the phrases (``size`` words each)."""
    if not phrases:
        return np.zeros(0, dtype=np.int64)
    auto = ahocorasick.Automaton()
    for p in phrases:
        auto.add_word((b" " + p + b" ").decode("latin-1"), True)
    auto.make_automaton()
    ends = np.fromiter((end for end, _ in auto.iter((b" " + b" ".join(words) + b" ").decode("latin-1"))), dtype=np.int64)
    blank_after = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    return np.searchsorted(blank_after, ends) - size + 1


#: what leaves a shard: a run of candidate windows (``hashes``), or with none a range of
#: windows known to repeat; ``first`` counts the words of the shard, in order of document
RUN = "spread long, shard long, no_id boolean, rid long, th long, first int, windows int, hashes binary"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
#: a range of windows to remove
GONE = "shard long, first int, windows int"


def _in_order(docs: pa.Table) -> tuple[list[tuple], list[str | None]]:
    """The distinct documents of a shard by (id missing, id, text hash), and their texts."""
    rows = sorted({(n, r, t): x for n, r, t, x in zip(*(docs.column(c).to_pylist() for c in ("no_id", "rid", "th", "text")))}.items())
    return [k for k, _ in rows], [x for _, x in rows]


def _ranges(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edge[0::2], edge[1::2] - edge[0::2]


def _spread_ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... of every range, concatenated."""
    before = np.cumsum(length) - length
    return np.arange(length.sum()) - np.repeat(before - start, length)


def candidates(docs: pa.Table, recurring: pa.Table, window: int, phrase: int, schema: pa.Schema, most: int = HOT) -> pa.Table:
    """Step 2 for one shard: rows of ``RUN``."""
    keys, texts = _in_order(docs)
    known = np.unique(recurring.column("anchor").to_numpy()).view(U64) if len(recurring) else np.zeros(0, dtype=U64)
    hot = recurring.filter(pa.compute.greater(recurring.column("n"), most)).column("anchor").to_numpy().view(U64) if len(recurring) else known
    w = Words(texts)
    anchor, place, first, end = w.runs(window, phrase)
    # one place of each recurring phrase gives its words; the automaton finds all the others
    some = np.flatnonzero(np.isin(anchor, known))
    some = some[np.unique(anchor[some], return_index=True)[1]]
    found = locate(w.words, list({b" ".join(w.words[p : p + phrase]) for p in place[some].tolist()}), phrase)
    spot = np.zeros(len(w.words) + 1, dtype=bool)
    spot[found] = True
    mine = np.flatnonzero(spot[place])
    anchor, first, end = anchor[mine], first[mine], end[mine]
    # equal runs of the shard after the first are repeats, whatever other shards hold
    content = np.zeros(0, dtype=U64) if not len(first) else span_hash(w.hashes, first, end + window - 1)
    fresh = np.zeros(len(first), dtype=bool)
    fresh[np.unique(content, return_index=True)[1]] = True
    grams = gram_hashes(w.hashes, window)
    repeat = np.zeros(len(grams) + 1, dtype=bool)
    repeat[_spread_ranges(first[~fresh], (end - first)[~fresh])] = True
    anchor, first, size = anchor[fresh], first[fresh], (end - first)[fresh]
    # windows of hot anchors go one by one, by their own hash; the shard's later ones are repeats
    much = np.isin(anchor, hot)
    single = np.sort(_spread_ranges(first[much], size[much]).astype(np.int64))
    alone, at = np.unique(grams[single], return_index=True)
    again = np.ones(len(single), dtype=bool)
    again[at] = False
    repeat[single[again]] = True
    r_first, r_size = _ranges(repeat)
    anchor = np.concatenate((anchor[~much], mix64(alone)))
    first, size = np.concatenate((first[~much], single[at])), np.concatenate((size[~much], np.ones(len(at), dtype=np.int64)))
    n, m = len(first), len(r_first)
    shard = docs.column("shard")[0].as_py() if len(docs) else 0
    owner = w.text_of[np.concatenate((first, r_first)).astype(np.int64)]
    no_id, rid, th = (np.array([k[i] for k in keys], dtype=t)[owner] if len(keys) else np.zeros(0, dtype=t) for i, t in ((0, bool), (1, np.int64), (2, np.int64)))
    flat = grams[_spread_ranges(first, size)].tobytes()
    offsets = np.concatenate((np.cumsum(np.concatenate(([0], size * 8))), np.full(m, size.sum() * 8))).astype(np.int32)
    valid = pa.array(np.concatenate((np.ones(n, dtype=bool), np.zeros(m, dtype=bool)))).buffers()[1]
    hashes = pa.Array.from_buffers(pa.binary(), n + m, [valid, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat)])
    spread = np.concatenate((signed(anchor), signed(mix64(r_first.astype(U64) + U64(shard) * U64(1 << 32)))))
    cols = [spread, np.full(n + m, shard), no_id, rid, th, np.concatenate((first, r_first)), np.concatenate((size, r_size))]
    arrays = [pa.array(c).cast(f.type) for c, f in zip(cols, schema)]
    return pa.Table.from_arrays([*arrays, hashes], schema=schema)


def confirm(runs: pa.Table, schema: pa.Schema) -> pa.Table:
    """Step 3 for one bucket of anchors: ranges of windows that also start earlier."""
    runs = runs.combine_chunks()
    known = runs.filter(pa.compute.is_null(runs.column("hashes")))
    fresh = runs.filter(pa.compute.is_valid(runs.column("hashes")))
    out = [known.select(["shard", "first", "windows"])]
    if len(fresh):
        col = lambda name: fresh.column(name).to_numpy()
        order = np.lexsort((col("first"), col("th"), col("rid"), col("no_id")))
        fresh = fresh.take(pa.array(order))
        size, first, shard = (fresh.column(x).to_numpy().astype(np.int64) for x in ("windows", "first", "shard"))
        flat = np.frombuffer(b"".join(fresh.column("hashes").to_pylist()), dtype=U64)
        again = np.ones(len(flat), dtype=bool)
        again[np.unique(flat, return_index=True)[1]] = False
        run = np.repeat(np.arange(len(size)), size)
        place = _spread_ranges(first, size)
        hit = np.flatnonzero(again)
        new = np.concatenate(([True], (np.diff(hit) != 1) | (np.diff(run[hit]) != 0))) if len(hit) else np.zeros(0, dtype=bool)
        start = np.flatnonzero(new)
        length = np.diff(np.concatenate((start, [len(hit)])))
        at = hit[start]
        out.append(pa.table({"shard": shard[run[at]], "first": place[at].astype(np.int32), "windows": length.astype(np.int32)}))
    return pa.concat_tables([t.cast(schema) for t in out])


def strip(docs: pa.Table, gone: pa.Table, window: int, keep_text: bool, schema: pa.Schema) -> pa.Table:
    """Step 4 for one shard: words, removed words and digest (and text) of what is left."""
    keys, texts = _in_order(docs)
    w = Words(texts)
    step = np.zeros(len(w.words) + 1, dtype=np.int64)
    if len(gone):
        first, size = gone.column("first").to_numpy().astype(np.int64), gone.column("windows").to_numpy()
        np.add.at(step, first, 1)
        np.add.at(step, first + size + window - 1, -1)
    left = np.cumsum(step[:-1]) == 0
    result = {}
    for key, a, b in zip(keys, w.edges[:-1], w.edges[1:]):
        n = int(left[a:b].sum())
        kept = b" ".join(w.words[a:b] if n == b - a else compress(w.words[a:b], left[a:b]))
        result[key] = (None if key[0] else key[1], int(b - a), int(b - a) - n, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace") if keep_text else None)
    rows = [result[k] for k in zip(*(docs.column(c).to_pylist() for c in ("no_id", "rid", "th")))]
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(schema)], schema=schema)


def dedup_substrings(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, shard_bytes: int = SHARD_BYTES, keep_text: bool = True, most: int = HOT) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256, kept``."""
    sharded, shards = _sharded(docs, shard_bytes)
    by_shard = sharded.groupBy("shard")
    run_schema, gone_schema, result_schema = (to_arrow_schema(T._parse_datatype_string(x)) for x in (RUN, GONE, RESULT))
    phrases = recurring_phrases(sharded, window, phrase)
    runs = by_shard.cogroup(phrases.groupBy("shard")).applyInArrow(lambda d, p: candidates(d, p, window, phrase, run_schema, most), RUN)
    buckets = max(1, -(-shards // 8))
    gone = runs.withColumn("bucket", F.pmod("spread", F.lit(buckets))).groupBy("bucket").applyInArrow(lambda r: confirm(r, gone_schema), GONE)
    return by_shard.cogroup(gone.groupBy("shard")).applyInArrow(lambda d, g: strip(d, g, window, keep_text, result_schema), RESULT)


ORACLE = r"""
with d as (select row_number() over (order by doc_id nulls last) as rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (select rid, i, array_to_string(w[i : i + 19], ' ') as g from (select rid, w, unnest(range(1, len(w) - 18)) as i from d where len(w) >= 20)),
again as (select rid, i from (select rid, i, row_number() over (partition by g order by rid, i) as k from win) where k > 1),
gone as (select rid, list(distinct i + k) as p from (select rid, i, unnest(range(0, 20)) as k from again) group by rid),
kept as (
  select d.rid, doc_id, len(w) as n_words, coalesce(len(p), 0) as n_removed,
         case when p is null then w else list_filter(w, lambda x, i: not list_contains(p, i)) end as k
  from d left join gone using (rid))
select doc_id, cast(n_words as bigint) as n_words, cast(n_removed as bigint) as n_removed, sha256(array_to_string(k, ' ')) as kept_sha256 from kept
"""


@register("op5_substring_dedup", ORACLE)
def op5_substring_dedup(spark, sf_dir):
    """Every document, windows of 20 words."""
    return dedup_substrings(table(spark, sf_dir, "documents"), keep_text=False).drop("kept")
