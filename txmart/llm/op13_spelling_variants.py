"""Spelling variant grouping: a relational trie frontier finds all words one edit apart.

Words are runs of letters, counted over all documents. They are held as two tries, one of
the words and one of the reversed words, each as a distributed edge table
``(dir, depth, node, ch, child, kids, is_word)``: a node is a prefix, ``kids`` the letters
that may follow the child. Two words one edit apart agree on one half, so a state needs to
branch in the other half only: ``(word, position, node, edits)`` starts with no edit at the
middle of its word (in either trie), and level by level the frontier is joined with the
edges of one depth:

* the edge of the word's own letter keeps the number of edits,
* an edge of another letter is a replacement (first edit only),
* a state may stay at its node and skip a letter: a deletion.

A state lives on only if ``kids`` holds its next letter. A state that has read its whole
word with one edit names a neighbour: another word. Only the longer word deletes and only
the smaller letter is replaced, and in a run of one letter only its outer one is deleted,
so every pair is found exactly once. Each level is written to the shared folder; every edge
is shuffled once. A node has at most one edge per letter, so a hot node multiplies a
state by no more than the alphabet, and adaptive execution can split its states.

A trie level per letter suits words, not runs of letters that fill a page: pairs whose
longer word has more than ``max_trie`` letters are found by the hashes of the word without
one letter (all of a word in one numpy step, one row a letter) and checked exactly.

Defined cases: null or empty text: no words; null doc_id: counts as the empty string in the
hash that picks noise; repeated rows count again; ties in ``n``: the smaller word; empty
table: no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txmart.llm.common import U64, _powers, materialize, mix64, record_batch, register, signed, table, to_arrow_schema

RUN = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_TRIE = 64
HASHED = "wid long, size int, at int, hash long, full long"
_BASE, _INVERSE = U64(0x9E3779B97F4A7C15), U64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def noisy_words(docs: DataFrame, min_chars: int = 7, noise: int = 31) -> DataFrame:
    """One row ``word`` per run of letters that leaves at least ``min_chars`` letters; where
    ``noise`` divides the crc32 of ``doc_id:run``, the run loses the letter that it names."""
    run = F.explode(F.regexp_extract_all("text", F.lit(f"({RUN}{{{min_chars},}})"), F.lit(1)))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), run.alias("run"))
    lowered = runs.select("doc", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run")).alias("run"))
    h = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = lowered.select("run", h.alias("h")).select(F.when(F.col("h") % noise == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= min_chars)


def count_words(words: DataFrame, min_count: int = 2) -> DataFrame:
    """``word, n`` of all words seen ``min_count`` times or more."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


# ---------------------------------------------------------------- the trie frontier


def oriented(words: DataFrame) -> DataFrame:
    """``dir, w, size, half``: every word forwards and backwards, and where its states start."""
    size = F.length("word")
    half = F.floor(size / 2).cast("int")
    both = F.explode(F.array(
        F.struct(F.lit(0).alias("dir"), F.col("word").alias("w"), half.alias("half")),
        F.struct(F.lit(1).alias("dir"), F.reverse("word").alias("w"), (size - half).alias("half")),
    ))
    return words.select(size.alias("size"), both.alias("o")).select("o.dir", "o.w", "size", "o.half")


def letter(word: str, at: Column) -> Column:
    """The letter of ``word`` at ``at`` (from 0; '' beyond the end)."""
    return F.substring(F.col(word), at + 1, F.lit(1))


def outermost(at: Column) -> Column:
    """Of a run of one letter only the letter farthest from the start of the word may be
    deleted, in either trie, so that a deletion is found once."""
    return F.when(F.col("dir") == 0, letter("w", at) != letter("w", at + 1)).otherwise(letter("w", at) != letter("w", at - 1))


def trie_edges(words: DataFrame) -> DataFrame:
    """The edges below the middle of the oriented words, one row per child node."""
    depth = F.explode(F.sequence(F.col("half") + 1, F.col("size")))
    steps = words.select("dir", "w", "size", depth.alias("to"))
    steps = steps.select("dir", F.substring("w", F.lit(1), F.col("to")).alias("child"), "to", letter("w", F.col("to")).alias("next"))
    nodes = steps.groupBy("dir", "child", "to").agg(F.array_join(F.collect_set("next"), "").alias("kids"), F.max(F.col("next") == "").alias("is_word"))
    return nodes.select(
        "dir", (F.col("to") - 1).alias("depth"), F.substring("child", F.lit(1), F.col("to") - 1).alias("node"), letter("child", F.col("to") - 1).alias("ch"), "child", "kids", "is_word"
    )


def trie_step(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """States ``(dir, w, size, pos, node, edits)`` of one depth, joined with its edges."""
    skip = F.struct((F.col("pos") + 1).alias("pos"), F.lit(1).alias("edits"))
    stay = F.struct("pos", "edits")
    deletes = (F.col("edits") == 0) & (F.col("pos") + 1 < F.col("size")) & outermost(F.col("pos"))
    states = frontier.select("dir", "w", "size", "node", F.explode(F.when(deletes, F.array(stay, skip)).otherwise(F.array(stay))).alias("s"))
    states = states.select("dir", "w", "size", "node", "s.pos", "s.edits")
    states = states.withColumns({"own": letter("w", F.col("pos")), "after": letter("w", F.col("pos") + 1)})
    goes_on = F.when(F.col("pos") + 1 == F.col("size"), F.col("is_word")).otherwise(F.contains("kids", "after"))
    keeps = (F.col("ch") == F.col("own")) & F.when(F.col("edits") == 0, F.col("pos") + 1 < F.col("size")).otherwise(goes_on)
    replaces = (F.col("edits") == 0) & (F.col("ch") > F.col("own")) & goes_on
    walked = states.join(edges.select("dir", "node", "ch", "child", "kids", "is_word"), ["dir", "node"]).where(keeps | replaces)
    return walked.select("dir", "w", "size", (F.col("pos") + 1).alias("pos"), F.col("child").alias("node"), (F.col("edits") + F.when(F.col("ch") == F.col("own"), 0).otherwise(1)).alias("edits"))


def trie_pairs(words: DataFrame) -> DataFrame:
    """``a, b``: every pair of ``words(word)`` one edit apart, once (b may be no word where a
    last letter was deleted)."""
    both = materialize(oriented(words), "variant-words")
    edges = materialize(trie_edges(both).sortWithinPartitions("depth"), "variant-edges")
    low, high = both.agg(F.min("half"), F.max("size")).first()
    # a deletion of the last letter reads its word without taking an edge
    last = both.where(outermost(F.col("size") - 1)).select("dir", "w", F.substring("w", F.lit(1), F.col("size") - 1).alias("node"))
    ends, frontier = last, None
    for depth in range(low or 0, high or 0):
        start = both.where(F.col("half") == depth).select("dir", "w", "size", F.col("half").alias("pos"), F.substring("w", F.lit(1), F.col("half")).alias("node"), F.lit(0).alias("edits"))
        states = start if frontier is None else frontier.unionByName(start)
        made = materialize(trie_step(states, edges.where(F.col("depth") == depth)), "variant-level")
        ends = ends.unionByName(made.where("pos = size").select("dir", "w", "node"))
        frontier = made.where("pos < size")
    turn = lambda c: F.when(F.col("dir") == 1, F.reverse(c)).otherwise(F.col(c))
    return ends.select(turn("w").alias("a"), turn("node").alias("b"))


# ---------------------------------------------------------------- words beyond the trie


def cut_hashes(word: str) -> tuple[np.ndarray, int]:
    """Polynomial hashes of ``word`` without each of its letters, and of the whole word."""
    letters = mix64(np.frombuffer(word.encode("utf-32-le"), dtype=np.uint32).astype(U64) + U64(1))
    terms = letters * _powers(_BASE, len(letters))
    upto = np.cumsum(terms, dtype=U64)
    cut = (upto - terms) + (upto[-1] - upto) * _INVERSE
    return signed(mix64(cut)), int(signed(mix64(upto[-1:]))[0])


def long_pairs(words: DataFrame, max_trie: int = MAX_TRIE) -> DataFrame:
    """``a, b``: the pairs one edit apart whose longer word has more than ``max_trie`` letters."""
    some = words.where(F.length("word") >= max_trie).select("word", F.xxhash64("word").alias("wid"))
    schema = T._parse_datatype_string(HASHED)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for word, wid in zip(b.column("word").to_pylist(), b.column("wid").to_pylist()):
                cut, full = cut_hashes(word)
                n = len(cut)
                yield record_batch([pa.array(np.full(n, wid)), pa.array(np.full(n, n, np.int32)), pa.array(np.arange(n, dtype=np.int32)), pa.array(cut), pa.array(np.full(n, full))], arrow)

    cuts = materialize(some.mapInArrow(run, schema), "variant-long")
    one = cuts.where(F.col("size") > max_trie).select(F.col("wid").alias("u"), "size", "at", "hash")
    replaced = one.join(one.withColumnRenamed("u", "v"), ["size", "at", "hash"]).where("u < v").select("u", "v")
    whole = cuts.where("at = 0").select(F.col("wid").alias("v"), F.col("size").alias("size_v"), F.col("full").alias("hash"))
    deleted = one.join(whole, "hash").where(F.col("size") == F.col("size_v") + 1).select("u", "v")
    ids = replaced.unionByName(deleted).distinct()
    named = ids.join(some.select(F.col("wid").alias("u"), F.col("word").alias("a")), "u").join(some.select(F.col("wid").alias("v"), F.col("word").alias("b")), "v")
    return named.where(F.levenshtein("a", "b", 1) == 1).select("a", "b")


# ---------------------------------------------------------------- forms and roots


def near_pairs(words: DataFrame, max_trie: int = MAX_TRIE) -> DataFrame:
    """``a, b``: every pair of ``words(word)`` that are one edit apart, once."""
    short = trie_pairs(words.where(F.length("word") <= max_trie).select("word"))
    return short.unionByName(long_pairs(words, max_trie))


def spelling_forms(counted: DataFrame, ratio: int = 10, max_trie: int = MAX_TRIE) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of ``counted(word, n)``: the form is the most
    frequent near word where it is ``ratio`` times as frequent; the root ends the forms."""
    counted = counted.select("word", "n")
    pairs = near_pairs(counted, max_trie)
    named = pairs.join(counted.select(F.col("word").alias("a"), F.col("n").alias("n_a")), "a").join(counted.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b")
    sides = F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("word")).alias("near")),
        F.struct(F.col("b").alias("word"), F.struct((-F.col("n_a")).alias("less"), F.col("a").alias("word")).alias("near")),
    ))
    near = named.select(sides.alias("s")).groupBy(F.col("s.word").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), F.min("s.near").alias("best"))
    joined = counted.join(near, "word", "left")
    enough = -F.col("best.less") >= ratio * F.col("n")
    shaped = materialize(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best.word")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")
        ),
        "variant-forms",
    )
    roots = follow(shaped.where("form is not null").select("word", "form"))
    return shaped.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def follow(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``forms(word, form)`` without cycles, by pointer doubling: a form is
    at least twice as frequent as its word, so chains are short and few rounds are made."""
    cur = forms.select("word", F.col("form").alias("root"))
    while True:
        step = cur.join(cur.select(F.col("word").alias("root"), F.col("root").alias("beyond")), "root", "left")
        cur = materialize(step.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "variant-roots")
        if cur.where("moved").isEmpty():
            return cur.select("word", "root")
        cur = cur.select("word", "root")


@register("op13_spelling_variants")
def op13_spelling_variants(spark, sf_dir):
    """Every word of all documents with its near words, form and root."""
    words = count_words(noisy_words(table(spark, sf_dir, "documents").select("doc_id", "text")))
    forms = spelling_forms(materialize(words, "variant-counts"))
    return forms.select("word", "form", "root", "n", "n_near", "form_n")
