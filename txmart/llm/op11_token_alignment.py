"""Cross-tokenizer alignment: divide and conquer at the byte ends that two tokenizers share.

Every text is encoded by tokenizer A (byte-level BPE, a space put before the text) and B
(piece BPE, which puts the space itself). The running byte ends of a document's A and B
tokens are two sorted lists whose last ends are equal. An interval between two shared ends
is handled by one rule: starting at the A end in its middle, bisect B for the first end at
or beyond it, bisect A for the first end at or beyond that, and so on until both agree or the
interval ends; then the same to the left. A shared end cuts the interval and both halves are
handled alike; an interval without one is a leaf, a group of A tokens over a group of B
tokens. The intervals of all documents of a slice are divided level by level, each step one
numpy bisect over all of them, so recursion costs no stack and no Python per token.

``align`` gives tokens, groups (``a1,a2|b1;a3|b2,b3``) and the id pairs linked per document;
``pair_counts`` counts linked pairs over the corpus (partial sums per Arrow batch, at most
one row per pair of the vocabularies after the shuffle) and marks the most frequent partners of
every B id; ``link_scores`` sums both per document. The pair table is broadcast while it has at
most ``max_broadcast`` rows (17 bytes each), else documents are joined with it on the pair.

Defined cases: null or empty text, and a text whose tokens' bytes differ from space + text
(U+2581 in it): no tokens, zeros and an empty ``groups``; special tokens' strings are plain
text; long texts are encoded in pieces cut before a space where neither tokenizer can merge;
repeated rows and null ids are documents like any other; extra columns travel in ``doc``;
empty table: no rows.
"""

from __future__ import annotations

import itertools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txmart.llm.common import materialize, record_batch, register, table, to_arrow_schema

VOCABULARY_A = "/opt/tokenizers/byte_bpe_50k.json"
VOCABULARY_B = "/opt/tokenizers/piece_bpe_32k.model"
MAX_VOCABULARY_BYTES = 64 << 20
#: rows of the pair table that every Python worker may hold (17 bytes each)
MAX_BROADCAST = 4_000_000
ROWS, ROW_CHARS = 128, 1 << 20
PIECE = 1 << 17
#: a place where no token of either kind spans: before a space between plain characters
_SEAM = re.compile(r"(?<=[A-Za-z0-9.,;:!?]) (?=[A-Za-z])")
#: fixed value: the pattern that splits a text before byte-level BPE
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHIFT = 32

ALIGNED = "rid long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<int>"


# ---------------------------------------------------------------- tokenizers


def load_vocabulary(path: str) -> bytes:
    """A vocabulary file, read on the driver, its size checked before it is broadcast."""
    if (size := os.path.getsize(path)) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has {size} bytes; a vocabulary is broadcast only up to {MAX_VOCABULARY_BYTES}")
    with open(path, "rb") as f:
        return f.read()


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes stand
    for themselves, the others for the code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level(model: dict) -> tuple[dict[str, int], set[int]]:
    """(token -> id, special ids) of a byte-level BPE file. Its merges must be in the order of
    their ids: then ranks are ids, and the rank-based encoder (four times as fast here as the
    general one, with the same result) applies."""
    bpe, split = model["model"], model.get("pre_tokenizer") or {}
    special = {t["id"] for t in model.get("added_tokens", ())}
    words = {**bpe["vocab"], **{t["content"]: t["id"] for t in model.get("added_tokens", ())}}
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in bpe["merges"]]
    ids = [words[m] for m in merged]
    plain = bpe["type"] == "BPE" and not model.get("normalizer") and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    if not plain or ids != sorted(ids) or len(words) != len(special | set(ids)) + 256:
        raise ValueError("vocabulary A must be a plain byte-level BPE whose merges are in the order of their ids")
    return words, special


class Tokens:
    """Both tokenizers with the bytes of every token."""

    def __init__(self, a: bytes, b: bytes):
        import sentencepiece
        import tiktoken

        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        letters = byte_letters()
        words, special = byte_level(json.loads(a))
        self.bytes_a = [b""] * (max(words.values()) + 1)
        for word, i in words.items():
            self.bytes_a[i] = bytes(letters[c] for c in word) if i not in special else b""
        ranks = {x: i for i, x in enumerate(self.bytes_a) if i not in special}
        self.a = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.bytes_a, self.bytes_b))
        # '<id>,' of both kinds, '<id>|' after the A tokens of a group, '<id>;' after its B tokens
        top = self.top = max(len(self.bytes_a), len(self.bytes_b))
        self.written = [f"{i}{mark}" for mark in ",|;" for i in range(top)]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        return [self.a.encode_ordinary(" " + t) for t in texts], self.b.encode(texts, num_threads=1)

    def tokens(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """(A ids, B ids) of every text; both empty where they do not spell space + text."""
        parts, owner = [], []
        for i, text in enumerate(texts):
            for piece in pieces_of(text) if text else ():
                parts.append(piece)
                owner.append(i)
        out: list[tuple[list[int], list[int]]] = [([], []) for _ in texts]
        for i, a, b in zip(owner, *self.encode(parts)) if parts else ():
            out[i][0].extend(a)
            out[i][1].extend(b)
        for i, text in enumerate(texts):
            if text:
                raw, (a, b) = (" " + text).encode("utf-8", "surrogatepass"), out[i]
                if b"".join(map(self.bytes_a.__getitem__, a)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
                    out[i] = ([], [])
        return out


def pieces_of(text: str) -> list[str]:
    """The text, or for a long one its pieces; a piece begins after the space at a seam, as
    both tokenizers put a space before what they encode."""
    out, at = [], 0
    while len(text) - at > PIECE and (seam := _SEAM.search(text, at + PIECE)):
        out.append(text[at : seam.start()])
        at = seam.end()
    return [*out, text[at:]]


# ---------------------------------------------------------------- divide and conquer


def shared_near_middle(ends_a: np.ndarray, ends_b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """For each interval of A tokens [lo, hi], whose last end is shared: an index in [lo, hi)
    whose end B shares, found from the middle by bisects in turn, or -1."""
    found = np.full(len(lo), -1, dtype=np.int64)
    mid = (lo + hi) // 2
    open_, at = np.arange(len(lo)), mid.copy()
    while len(open_):  # to the right of the middle
        x = ends_a[at]
        y = ends_b[np.searchsorted(ends_b, x)]
        hit = y == x
        found[open_[hit]] = at[hit]
        open_, at = open_[~hit], np.searchsorted(ends_a, y[~hit])
        inside = at < hi[open_]
        open_, at = open_[inside], at[inside]
    open_ = np.flatnonzero((found < 0) & (mid > lo))
    at = mid[open_] - 1
    while len(open_):  # to the left of it
        x = ends_a[at]
        b = np.searchsorted(ends_b, x, side="right") - 1
        y = np.where(b >= 0, ends_b[b], -1)
        hit = y == x
        found[open_[hit]] = at[hit]
        open_, at = open_[~hit], np.searchsorted(ends_a, y[~hit], side="right") - 1
        inside = at >= lo[open_]
        open_, at = open_[inside], at[inside]
    return found


def shared_ends(ends_a: np.ndarray, ends_b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Indices of all A ends that B shares, in order. [lo, hi] are the first and last A token
    of every document; the last ends are shared."""
    cuts = [hi]
    while len(lo):
        more = hi > lo
        lo, hi = lo[more], hi[more]
        cut = shared_near_middle(ends_a, ends_b, lo, hi)
        split = cut >= 0
        lo, hi, cut = lo[split], hi[split], cut[split]
        cuts.append(cut)
        lo, hi = np.concatenate([lo, cut + 1]), np.concatenate([cut, hi])
    return np.sort(np.concatenate(cuts))


def align_tokens(tokens: Tokens, texts: list[str | None]) -> list[tuple]:
    """``n_a, n_b, n_groups, n_links, groups, pairs, times`` of every text."""
    ids = tokens.tokens(texts)
    n_a, n_b = (np.array([len(x[k]) for x in ids], dtype=np.int64) for k in (0, 1))
    a, b = (np.fromiter(itertools.chain.from_iterable(x[k] for x in ids), dtype=np.int64, count=int(n.sum())) for k, n in ((0, n_a), (1, n_b)))
    ends_a, ends_b = np.cumsum(tokens.size_a[a]), np.cumsum(tokens.size_b[b])
    last, some = np.cumsum(n_a) - 1, n_a > 0
    cut = shared_ends(ends_a, ends_b, (last - n_a + 1)[some], last[some])
    cut_b = np.searchsorted(ends_b, ends_a[cut])
    closes_a, closes_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
    closes_a[cut] = closes_b[cut_b] = 1
    # groups in order, the A tokens of each before its B tokens
    order = np.argsort(np.concatenate([np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b]), kind="stable")
    marked = np.concatenate([a + closes_a * tokens.top, b + closes_b * 2 * tokens.top])[order].tolist()
    linked = (a[cut] << SHIFT) | b[cut_b]
    groups = np.bincount(np.searchsorted(last, cut), minlength=len(texts))  # a cut belongs to the document whose last token is not before it
    out, at, link = [], 0, 0
    for i, n in enumerate((n_a + n_b).tolist()):
        k = int(groups[i])
        pairs, times = np.unique(linked[link : link + k], return_counts=True)
        out.append((int(n_a[i]), int(n_b[i]), k, k, "".join(map(tokens.written.__getitem__, marked[at : at + n]))[:-1], pairs, times.astype(np.int32)))
        at, link = at + n, link + k
    return out


# ---------------------------------------------------------------- over the corpus


def align(docs: DataFrame, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B) -> DataFrame:
    """One row per document: ``doc`` (its row as a struct), ``rid`` (a number of its own once
    the rows are written), ``n_a, n_b, n_groups, n_links``, ``groups``, and the distinct id
    pairs linked in it with how often (``pairs`` = A id << 32 | B id, ``times``)."""
    shared = docs.sparkSession.sparkContext.broadcast((load_vocabulary(vocabulary_a), load_vocabulary(vocabulary_b)))
    picked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    schema = T.StructType(picked.schema.fields + T._parse_datatype_string(ALIGNED).fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, rid = Tokens(*shared.value), TaskContext.get().partitionId() << 33
        for batch in batches:
            for b in slices(batch):
                rows = align_tokens(tokens, b.column(0).field("text").to_pylist())
                yield record_batch([b.column(0), list(range(rid, rid + len(rows))), *([r[k] for r in rows] for k in range(7))], arrow)
                rid += len(rows)

    return picked.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most ROWS documents and about ROW_CHARS bytes of text."""
    text = batch.column(0).field("text")
    size = pc.fill_null(pc.binary_length(text), 0).to_numpy()
    at = n = total = 0
    for i in range(len(batch)):
        if n and (n == ROWS or total + size[i] > ROW_CHARS):
            yield batch.slice(at, n)
            at, n, total = i, 0, 0
        n, total = n + 1, total + size[i]
    if n:
        yield batch.slice(at, n)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n, best``: how many links of the corpus hold each pair, and whether no other
    pair of its B id has more."""
    schema = T._parse_datatype_string("pair long, n long")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pair, at = np.unique(b.column("pairs").flatten().to_numpy(zero_copy_only=False), return_inverse=True)
            yield record_batch([pa.array(pair), pa.array(np.bincount(at, b.column("times").flatten().to_numpy(zero_copy_only=False), len(pair)).astype(np.int64))], arrow)

    counts = materialize(aligned.select("pairs", "times").mapInArrow(run, schema).groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1))
    most = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("most"))  # at most one row per id of B
    return counts.withColumn("b", b_id).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def link_scores(aligned: DataFrame, counts: DataFrame, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """The rows of ``aligned`` (written, so that ``rid`` is fixed) with ``n_best, count_sum``
    in place of ``pairs, times``."""
    kept = [c for c in aligned.columns if c not in ("pairs", "times")]
    if counts.count() <= max_broadcast:
        return _looked_up(aligned, counts, kept)
    each = aligned.select("rid", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("rid", F.col("p.pairs").alias("pair"), F.col("p.times").cast("long").alias("times"))
    best = F.when(F.col("best"), F.col("times")).otherwise(F.lit(0).cast("long"))
    sums = each.join(counts, "pair").groupBy("rid").agg(F.sum(best).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return aligned.select(*kept).join(sums, "rid", "left").select(*kept, F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"))


def _looked_up(aligned: DataFrame, counts: DataFrame, kept: list[str]) -> DataFrame:
    rows = counts.toArrow().sort_by("pair")
    shared = aligned.sparkSession.sparkContext.broadcast(tuple(rows.column(c).to_numpy() for c in ("pair", "n", "best")))
    schema = T.StructType([aligned.schema[c] for c in kept] + T._parse_datatype_string("n_best long, count_sum long").fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = shared.value
        for b in batches:
            lists = b.column("pairs")
            times = b.column("times").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(pair, lists.flatten().to_numpy(zero_copy_only=False))
            ends = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))))
            upto = [np.concatenate(([0], np.cumsum(x))) for x in (times * best[at], times * n[at])] if len(at) else [np.zeros(1, np.int64)] * 2
            yield record_batch([*(b.column(c) for c in kept), *(pa.array(u[ends[1:]] - u[ends[:-1]]) for u in upto)], arrow)

    return aligned.mapInArrow(run, schema)


@register("op11_token_alignment")
def op11_token_alignment(spark, sf_dir):
    """Every document under both tokenizers, its groups and how usual its links are."""
    aligned = align(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit("")).alias("groups_sha256")
    written = materialize(aligned.select("rid", F.col("doc.doc_id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "times"), "aligned")
    scored = link_scores(written, pair_counts(written))
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
