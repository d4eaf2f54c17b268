"""N-gram Jaccard join: MinHash LSH forest, then exact verification.

1. One Arrow map over the documents makes five-word shingle sets, and from each the set
   hash ``h`` (equal sets are one node from here on: exact copies collapse before any
   shuffle of pairs) and ``TREES`` x ``DEPTH`` MinHash values.
2. The forest: documents that share a prefix of a tree's ``DEPTH`` values are one branch. The
   prefix is the longest one whose recall at the threshold, ``1 - (1 - t**depth)**TREES``,
   reaches the target. A crowded branch (over ``CROWD`` nodes) is cut into salted parts, and
   every two parts meet in a task of their own: none is one task's burden, and every two
   nodes of a branch are compared, whatever its size.
3. Inside a branch, signatures estimate similarities; nodes within ``SLACK`` below the
   threshold are chained to a root. Only these star edges leave the task (linear in the
   nodes), and their connected components are the candidate groups.
4. Each candidate group is verified exactly on its shingle sets, every pair, in blocks of
   ``BLOCK`` nodes: a large group becomes many tasks of two blocks each. Tasks return, per
   node, the number of documents it is linked with, and a spanning star per linked cluster,
   never the pairs. Components of those stars are the classes.

Texts are shuffled once, to fetch the sets of nodes in candidate groups. A branch, a set of
equal copies or a group may hold a third of all documents: counts are combined map-side,
joins can be split by adaptive execution, branches and groups are cut as above. The number
of tasks of one branch or group grows with the square of its *distinct* texts; that is the
price of losing no link.

Defined cases: a text of one to four words has one shingle, all its words; null or blank
texts have none, link with nothing and are their own class; null ids are allowed (a class
takes its least id, null if it has none); repeated rows are copies of each other; ties in
similarity at exactly the threshold link; empty table: no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txmart.llm.common import U64, components, gram_hashes, materialize, mix64, record_batch, register, signed, table, to_arrow_schema, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.995
TREES, DEPTH = 16, 8
CROWD = 2048
SLACK = 0.14  # four standard deviations of the estimate from 128 values at 0.8
BLOCK = 512
_CHUNK = 1 << 15

_MULT = np.random.Generator(np.random.PCG64(7)).integers(0, 2**64, TREES * DEPTH, dtype=U64) | U64(1)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text."""
    words = word_hashes(b"" if text is None else text.encode("utf-8", "surrogatepass"))
    return np.unique(gram_hashes(words, min(size, len(words)))) if len(words) else words


def set_hash(grams: np.ndarray) -> np.uint64:
    """Order-free hash of a shingle set."""
    return mix64(np.array([mix64(grams).sum(dtype=U64) + U64(len(grams))], dtype=U64))[0]


def minhash(grams: np.ndarray) -> np.ndarray:
    """``TREES * DEPTH`` MinHash values (32 bits each)."""
    low = np.full(len(_MULT), np.iinfo(np.uint64).max, dtype=U64)
    for at in range(0, len(grams), _CHUNK):
        part = grams[at : at + _CHUNK]
        np.minimum(low, (part[None, :] * _MULT[:, None]).min(axis=1), out=low)
    return (low >> U64(32)).astype(np.uint32)


def match_depth(threshold: float = THRESHOLD, recall: float = TARGET_RECALL, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix that still reaches the target recall at the threshold."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def branch_keys(values: np.ndarray, depth: int) -> np.ndarray:
    """One key per tree: the hash of its first ``depth`` values and the tree number."""
    rows = values.reshape(TREES, DEPTH).astype(U64)
    key = mix64(np.arange(TREES, dtype=U64) * U64(1000) + U64(depth))
    for i in range(depth):
        key = mix64(key ^ (rows[:, i] + U64(0x9E3779B97F4A7C15)))
    return key


def _identity(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` and a row identity that allows null ids: ``rid`` (the id, else the
    text hash) and ``th`` (the text hash)."""
    th = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.select("doc_id", F.coalesce(F.col("doc_id"), th).alias("rid"), th.alias("th"), "text")


def signatures(docs: DataFrame, depth: int) -> DataFrame:
    """``doc_id, rid, th, h, n, sig, near``: ``h`` null without shingles; ``near`` are the
    branch keys at the matching depth."""
    picked = _identity(docs).select("doc_id", "rid", "th", F.col("text").alias("__text"))
    schema = T._parse_datatype_string("doc_id long, rid long, th long, h long, n int, sig binary, near array<long>")
    schema = T.StructType(picked.schema.fields[:3] + schema.fields[3:])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[], [], [], []]
            for text in b.column("__text").to_pylist():
                grams = shingles(text)
                if not len(grams):
                    row = (None, 0, None, None)
                else:
                    values = minhash(grams)
                    row = (int(set_hash(grams).view(np.int64)), len(grams), values.astype(np.uint16).tobytes(), signed(branch_keys(values, depth)))
                for c, v in zip(cols, row):
                    c.append(v)
            yield record_batch([b.column(i) for i in range(3)] + cols, arrow)

    return picked.mapInArrow(run, schema)


def stars(sig: np.ndarray, least: int) -> np.ndarray:
    """Root per row: rows whose signatures agree in ``least`` places are chained together."""
    root = np.full(len(sig), -1)
    open_rows = np.arange(len(sig))
    while len(open_rows):
        seed, open_rows = open_rows[0], open_rows[1:]
        root[seed] = seed
        queue = [seed]
        while queue and len(open_rows):
            near = (sig[open_rows] == sig[queue.pop()]).sum(axis=1) >= least
            new = open_rows[near]
            root[new] = seed
            queue.extend(new.tolist())
            open_rows = open_rows[~near]
    return root


def candidate_edges(nodes: DataFrame, threshold: float) -> DataFrame:
    """Star edges ``u, v`` between nodes of a branch whose estimated similarity is near the
    threshold or above. ``nodes``: one row per set hash, ``h, sig, near``."""
    spread = nodes.select("h", F.explode("near").alias("near"))
    sizes = spread.groupBy("near").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialize(spread.join(sizes, "near").withColumn("parts", F.ceil(F.col("n") / CROWD).cast("long")), "branches")
    plain = shared.where("parts = 1").select(F.col("near").alias("g"), "h")
    # each part goes to every other one, so two nodes of any parts, or of one part, meet
    part = F.pmod(F.xxhash64("h", "near"), F.col("parts"))
    crowded = shared.where("parts > 1").select("h", "near", part.alias("part"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other"))
    crowded = crowded.where("part <> other").select(F.xxhash64("near", F.least("part", "other"), F.greatest("part", "other")).alias("g"), "h")
    rows = plain.unionByName(crowded)
    total = shared.agg(F.coalesce(F.sum(F.greatest(F.lit(1), F.col("parts") - 1)), F.lit(0))).first()[0]
    bins = max(1, -(-total // 4000))
    least = int(np.ceil((threshold - SLACK) * TREES * DEPTH))

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["g", "h"])
        sig = np.frombuffer(b"".join(pdf["sig"]), dtype=np.uint16).reshape(len(pdf), -1)
        h, g = pdf["h"].to_numpy(), pdf["g"].to_numpy()
        cut = np.flatnonzero(np.diff(g)) + 1
        out = set()
        for lo, hi in zip(np.concatenate(([0], cut)), np.concatenate((cut, [len(g)]))):
            if hi - lo > 1:
                root = stars(sig[lo:hi], least)
                out.update((h[lo + r], h[lo + i]) for i, r in enumerate(root) if r != i)
        return pd.DataFrame(sorted(out), columns=["u", "v"], dtype="int64")

    binned = rows.join(nodes.select("h", "sig"), "h").withColumn("bin", F.pmod(F.col("g"), F.lit(bins)))
    return binned.groupBy("bin").applyInPandas(link, "u long, v long")


def _overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Intersection sizes of sets[left] x sets[right], from shingles that two sets share."""
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, token, times = np.unique(flat, return_inverse=True, return_counts=True)
    keep = times[token] > 1
    token, owner = token[keep], owner[keep]
    _, token = np.unique(token, return_inverse=True)
    out = np.zeros((len(left), len(right)), dtype=np.int64)  # float32 is exact in one step, not in the sum
    width = 4096
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    for at in range(0, int(token[-1]) + 1 if len(token) else 0, width):
        lo, hi = np.searchsorted(token, [at, at + width])
        have = np.zeros((len(sets), width), dtype=np.float32)
        have[owner[lo:hi], token[lo:hi] - at] = 1
        out += (have[left] @ have[right].T).astype(np.int64)
    return out


def verify_block(h: np.ndarray, copies: np.ndarray, block: np.ndarray, sets: list[np.ndarray], threshold: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Linked documents per node and a spanning star per cluster; with two blocks present
    only the pairs across them are looked at (each block has a task of its own)."""
    first = block == block.min()
    cross = not first.all()
    left = np.flatnonzero(first) if cross else np.arange(len(h))
    right = np.flatnonzero(~first) if cross else left
    both = _overlaps(sets, left, right)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    # in integers, so that a tie is a tie: shared / union >= over / under
    over, under = Fraction(threshold).limit_denominator(1_000_000).as_integer_ratio()
    linked = both * (over + under) >= over * (size[left][:, None] + size[right][None, :])
    if not cross:
        np.fill_diagonal(linked, False)
    count = np.zeros(len(h), dtype=np.int64)
    count[left] += linked @ copies[right]
    if cross:
        count[right] += linked.T @ copies[left]
    edges, seen = [], np.zeros(len(h), dtype=bool)
    at = {n: i for i, n in enumerate(left)}, {n: i for i, n in enumerate(right)}
    for seed in range(len(h)):
        if seen[seed] or not count[seed]:
            continue
        seen[seed], queue = True, [seed]
        while queue:
            x = queue.pop()
            near = np.zeros(len(h), dtype=bool)
            if x in at[0]:
                near[right[linked[at[0][x]]]] = True
            if cross and x in at[1]:
                near[left[linked[:, at[1][x]]]] = True
            for y in np.flatnonzero(near & ~seen):
                seen[y] = True
                edges.append((int(h[seed]), int(h[y])))
                queue.append(y)
    return count, edges


def verify(docs: DataFrame, nodes: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """Exact links inside candidate groups, rows ``u, v, links``: with u = v a node's partial
    number of linked documents, else a star edge. ``groups``: ``node, comp``."""
    member = groups.select(F.col("node").alias("h"), "comp").join(nodes.select("h", "copies", "n", "rid", "th"), "h")
    size = member.groupBy("comp").agg(F.count(F.lit(1)).alias("members"))
    member = materialize(member.join(size, "comp"), "members")
    total = member.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    bins = int(max(1, -(-total[0] // 1_000_000), -(-total[1] // 2000)))
    schema = T._parse_datatype_string("rid long, th long, h long, grams binary")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        for b in batches:
            grams = [shingles(t) for t in b.column("text").to_pylist()]
            h = [int(set_hash(g).view(np.int64)) if len(g) else None for g in grams]
            yield record_batch([b.column("rid"), b.column("th"), h, [g.tobytes() for g in grams]], arrow)

    own = _identity(docs).select("rid", "th", "text").join(member.select("rid", "th"), ["rid", "th"], "left_semi")
    sets = own.mapInArrow(sets_of, schema).dropDuplicates(["h"]).select("h", "grams")
    blocks = F.ceil(F.col("members") / BLOCK).cast("long")
    rows = member.join(sets, "h").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("h"), F.col("blocks")))
    rows = rows.select("comp", "h", "copies", "grams", "blocks", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    # small groups share tasks; each pair of blocks of a large group is a task of its own
    rows = rows.withColumn("task", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("comp"), F.lit(bins))).otherwise(F.xxhash64("comp", low, high)))

    def check(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in pdf.sort_values(["comp", "h"]).groupby("comp", sort=True):
            h = part["h"].to_numpy()
            sets = [np.frombuffer(g, dtype=U64) for g in part["grams"]]
            count, edges = verify_block(h, part["copies"].to_numpy(), part["block"].to_numpy(), sets, threshold)
            out += [(int(a), int(a), int(c)) for a, c in zip(h, count) if c] + [(u, v, 0) for u, v in edges]
        return pd.DataFrame(out, columns=["u", "v", "links"], dtype="int64")

    return rows.groupBy("task").applyInPandas(check, "u long, v long, links long")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> DataFrame:
    """One row per document: ``doc_id, rid, th`` and ``class_id`` (least id of its class),
    ``n_links`` (documents with similarity >= threshold to it), ``keeper`` (the one row
    identity of its class that a deduplication keeps: ``keep_rid, keep_th``)."""
    sig = materialize(signatures(docs, match_depth(threshold, recall)), "signatures")
    one = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("th"))
    nodes = materialize(
        sig.where("h is not null").groupBy("h").agg(
            F.count(F.lit(1)).alias("copies"), F.min(one).alias("least"), F.min(F.struct("rid", "th")).alias("id"),
            F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("near").alias("near"),
        ).select("h", "copies", "least", "id.rid", "id.th", "n", "sig", "near"),
        "nodes",
    )
    groups = components(candidate_edges(nodes.select("h", "sig", "near"), threshold))
    found = materialize(verify(docs, nodes, groups, threshold), "links")
    links = found.where("u = v").groupBy(F.col("u").alias("h")).agg(F.sum("links").alias("links"))
    comp = components(found.where("u <> v").select("u", "v"))
    per = nodes.select("h", "copies", "least").join(links, "h", "left").join(comp.withColumnRenamed("node", "h"), "h", "left")
    per = per.withColumn("comp", F.coalesce("comp", "h"))
    least = per.groupBy("comp").agg(F.min("least").alias("least"))
    per = per.drop("least").join(least, "comp").select("h", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    rows = sig.select("doc_id", "rid", "th", "h").join(per, "h", "left")
    keep = F.coalesce(F.col("least"), one)
    return rows.select("doc_id", "rid", "th", keep["doc_id"].alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce(keep["doc_id"], keep["th"]).alias("keep_rid"), keep["th"].alias("keep_th"))


def deduplicate(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row per class of near copies; rows whose text has no words all stay."""
    classes = near_duplicates(docs, threshold)
    keep = classes.where("rid = keep_rid and th = keep_th").select("rid", "th").distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    th = F.xxhash64(F.coalesce("doc.text", F.lit("")))
    keyed = whole.withColumn("th", th).withColumn("rid", F.coalesce("doc.doc_id", "th"))
    worded = F.coalesce(F.col("doc.text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = keyed.where(worded).join(keep, ["rid", "th"]).dropDuplicates(["rid", "th"])
    return kept.select("doc.*").union(whole.where(~worded).select("doc.*"))


@register("op2_jaccard_join")
def op2_jaccard_join(spark, sf_dir):
    """Every document against every other: class and number of links."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")
