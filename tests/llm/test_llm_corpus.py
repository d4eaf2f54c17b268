"""op2, op5, op8, op9, op10 and the pipeline: brute force, odd cases, empty tables."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import awkward_docs, awkward_texts, empty_docs, labels, words

import corpus_pipeline
from conftest import SF01
from pyspark.sql import functions as F
from txmart.llm import op02_jaccard_join as op2
from txmart.llm import op05_substring_dedup as op5
from txmart.llm import op08_token_counts as op8
from txmart.llm import op09_mix_sources as op9
from txmart.llm import op10_quality_classifier as op10
from txmart.llm.common import components, gram_hashes, table, word_hashes


def test_word_and_gram_hashes():
    a, b = word_hashes("the cat  sat\tthe\ncat é".encode()), word_hashes(b"cat the")
    assert len(a) == 6 and a[0] == a[3] == b[1] and a[1] == a[4] == b[0] and len(set(a.tolist())) == 4
    assert gram_hashes(a, 2)[0] == gram_hashes(a, 2)[3] and len(set(gram_hashes(a, 2).tolist())) == 4
    assert len(gram_hashes(a, 7)) == 0 and len(word_hashes(b"")) == 0 and len(word_hashes(b" \n")) == 0


@pytest.mark.parametrize("kind", ["path", "star", "random"])
def test_components(spark, kind):
    rng = random.Random(3)
    edges = {"path": [(i, i + 1) for i in range(40)], "star": [(7, i) for i in range(50)], "random": [(rng.randrange(90), rng.randrange(90)) for _ in range(50)]}[kind]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = sorted((find(u), find(v)))
            parent[b] = a
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def grams_of(text):
    ws = words(text)
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def brute_classes(rows):
    sets = [grams_of(t) for _, t in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j])
            if a and 5 * n >= 4 * (len(a) + len(sets[j]) - n):
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(d)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in ids.items()}
    return sorted(((d, least[find(i)], links[i]) for i, (d, _) in enumerate(rows)), key=repr), len(ids)


def test_jaccard_join_brute_force(spark):
    rng = random.Random(9)
    rows = list(awkward_texts())
    base = [f"b{rng.randrange(500)}" for _ in range(90)]
    for i in range(100, 160):  # a chain of near copies, some just under and over the threshold
        for _ in range(rng.randrange(3)):
            base[rng.randrange(len(base))] = f"n{i}"
        rows.append((i, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("th", F.lit("clash")).withColumn("h", F.lit("clash"))
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in op2.near_duplicates(docs).collect()), key=repr)
    want, _ = brute_classes(rows)
    assert got == want
    kept = op2.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted({c for _, c, _ in want} | {None}, key=repr) + ([None] if kept.where("doc_id is null").count() > 1 else [])


@pytest.mark.parametrize("shared,union", [(12, 15), (24, 30), (32, 40), (216, 270), (4000, 5000), (80_000, 100_000)])
def test_jaccard_ties_link(shared, union):
    """Exactly 0.8 links, inside a block and across two; one shingle more in the union does not."""
    base = np.arange(1, shared + 1, dtype=np.uint64)
    half = (union - shared) // 2
    more = lambda n, at: np.concatenate((base, np.arange(at, at + n, dtype=np.uint64)))
    for extra in (0, 1):
        sets = [more(half, 10**6), more(union - shared - half + extra, 2 * 10**6)]
        for block in ([0, 0], [0, 1]):
            count, edges = op2.verify_block(np.array([5, 6]), np.array([1, 1]), np.array(block), sets, op2.THRESHOLD)
            assert count.tolist() == [1 - extra] * 2 and len(edges) == 1 - extra


def test_deduplicate_keeps_every_wordless_row(spark):
    blank = [(None, None), (None, None), (None, ""), (7, None), (7, ""), (7, ""), (8, " \t\n\x0b\x0c\r"), (8, " \t\n\x0b\x0c\r")]
    docs = spark.createDataFrame([*blank, (1, "a b c"), (1, "a b c"), (2, " a b\nc"), (3, "\x1c"), (4, "\xa0")], "doc_id long, text string")
    got = op2.deduplicate(docs)
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter([*blank, (1, "a b c"), (3, "\x1c"), (4, "\xa0")])


def test_jaccard_blocks_and_crowded_branches(spark, monkeypatch):
    monkeypatch.setattr(op2, "CROWD", 8)
    monkeypatch.setattr(op2, "BLOCK", 7)
    rng = random.Random(2)
    base = [f"b{i}" for i in range(300)]
    rows = []
    for i in range(60):  # one group: every text within 0.8 of every other
        mine = list(base)
        mine[rng.randrange(300)] = f"x{i}"
        rows.append((i, " ".join(mine)))
    rows += [(1000 + i, " ".join(f"q{i}_{j}" for j in range(50))) for i in range(20)]
    got = {r.doc_id: (r.class_id, r.n_links) for r in op2.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: (0, 59) if i < 60 else (i, 0) for i, _ in rows}


def test_jaccard_lone_pairs_in_a_crowded_branch(spark, monkeypatch):
    """Pairs among many unlike texts of one branch (shared boilerplate) are all candidates."""
    monkeypatch.setattr(op2, "CROWD", 8)
    rng = np.random.default_rng(6)
    places = op2.TREES * op2.DEPTH
    rows = []
    for pair in range(50):
        sig = rng.integers(0, 2**16, places).astype(np.uint16)
        for twin in range(2):
            own = sig.copy()
            own[rng.permutation(places)[:10]] = rng.integers(0, 2**16, 10)
            rows.append((2 * pair + twin, bytearray(own.tobytes()), list(range(op2.TREES)), rng.integers(0, 2**60, op2.TREES).tolist()))
    nodes = spark.createDataFrame(rows, "h long, sig binary, near array<long>, far array<long>")
    got = {(min(r), max(r)) for r in op2.candidate_edges(nodes, op2.THRESHOLD).collect()}
    assert got == {(2 * i, 2 * i + 1) for i in range(50)}


def test_jaccard_empty_and_depth(spark):
    assert op2.near_duplicates(empty_docs(spark)).count() == 0 and op2.deduplicate(empty_docs(spark)).count() == 0
    k = op2.match_depth()
    assert 1 - (1 - 0.8**k) ** op2.TREES >= op2.TARGET_RECALL > 1 - (1 - 0.8 ** (k + 1)) ** op2.TREES


def brute_dedup(rows, window):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    seen, out = {}, [None] * len(rows)
    for i in order:
        ws = words(rows[i][1])
        gone = [False] * len(ws)
        for s in range(len(ws) - window + 1):
            key = tuple(ws[s : s + window])
            if seen.setdefault(key, (i, s)) != (i, s):
                gone[s : s + window] = [True] * window
        kept = b" ".join(w for w, g in zip(ws, gone) if not g)
        out[i] = (rows[i][0], len(ws), sum(gone), hashlib.sha256(kept).hexdigest())
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_dedup_brute_force(spark, seed):
    rng = random.Random(seed)
    passages = [[f"p{k}_{rng.randrange(6)}" for _ in range(rng.randrange(15, 60))] for k in range(6)]
    rows = [(None, None), (500, ""), (501, "a b c"), (502, "same " * 200)]
    for i in range(60):
        ws = []
        for _ in range(rng.randrange(1, 6)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            ws += p[a:] if rng.random() < 0.5 else p
            ws += [f"u{rng.randrange(4)}" for _ in range(rng.randrange(8))]
        rows.append((i if i % 9 else 1000 - i, " ".join(ws)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("clash"))
    got = op5.dedup_substrings(docs, shard_bytes=2000).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=repr) == brute_dedup(rows, 20)
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in got)


@pytest.mark.parametrize("most", [2, 20])
def test_substring_dedup_hot_anchors_brute_force(spark, most):
    rng = random.Random(8)
    passages = [[f"p{k}_{rng.randrange(6)}" for _ in range(rng.randrange(15, 60))] for k in range(4)]
    rows = [(None, " ".join(passages[0] * 3))]
    for i in range(60):
        ws = []
        for _ in range(rng.randrange(1, 6)):
            ws += rng.choice(passages) + [f"u{rng.randrange(4)}" for _ in range(rng.randrange(8))]
        rows.append((i if i % 9 else 1000 - i, " ".join(ws)))
    got = op5.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"), shard_bytes=2000, most=most).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=repr) == brute_dedup(rows, 20)


def test_substring_dedup_spreads_a_hot_anchor(spark):
    """A frequent phrase between unlike words: its rows do not all meet in one bucket."""
    phrase = min(([f"c{k}_{i}".encode() for i in range(5)] for k in range(3000)), key=lambda p: gram_hashes(word_hashes(b" ".join(p)), 5)[0])
    docs = [" ".join([f"a{d}_{i}" for i in range(40)] + [x.decode() for x in phrase] + [f"b{d}_{i}" for i in range(40)]) for d in range(30)]
    n = len(docs)
    shard = pa.table({"no_id": [False] * n, "rid": list(range(n)), "th": list(range(n)), "text": docs, "shard": [0] * n})
    anchor = gram_hashes(word_hashes(b" ".join(phrase)), 5).view(np.int64)
    schema = op5.to_arrow_schema(op5.T._parse_datatype_string(op5.RUN))
    for times, most in ((20_000, 1), (30, n)):
        runs = op5.candidates(shard, pa.table({"shard": [0], "anchor": anchor, "n": [times]}), 20, 5, schema)
        assert sum(runs.column("windows").to_pylist()) == 16 * n
        assert max(Counter(runs.column("spread").to_pylist()).values()) == most


def test_substring_dedup_cases(spark):
    got = op5.dedup_substrings(awkward_docs(spark)).collect()
    assert len(got) == len(awkward_texts())
    twins = [(r.n_removed, r.kept_sha256) for r in got if r.doc_id == 12]
    assert len(twins) == 2 and twins[0] == twins[1] and twins[0][0] == 90  # the passage stands in document 9
    assert next(r.n_removed for r in got if r.doc_id == 2) == 120 and next(r.n_removed for r in got if r.doc_id == 1) == 0
    assert op5.dedup_substrings(empty_docs(spark)).count() == 0


def test_token_counts(spark):
    docs = awkward_docs(spark)
    enc = op8.encoder(op8.load_ranks(op8.VOCABULARY))
    want = Counter((i, len(enc.encode_ordinary(t)) if t else 0) for i, t in awkward_texts())
    for block, group in ((7, 3), (1 << 16, 512)):
        blocks, order = op8.write_token_files(docs.repartition(3), block_tokens=block)
        got = op8.token_counts(blocks, group=group).join(order, ["file", "ordinal"])
        assert Counter((r.doc_id, r.n_tokens) for r in got.collect()) == want
    blocks, order = op8.write_token_files(empty_docs(spark))
    assert op8.token_counts(blocks).count() == 0 and order.count() == 0


def test_vocabulary_size_is_checked(monkeypatch):
    monkeypatch.setattr(op8, "MAX_VOCABULARY_BYTES", 1000)
    with pytest.raises(ValueError):
        op8.load_ranks(op8.VOCABULARY)


def test_token_files_from_outside(spark, tmp_path):
    rng = np.random.default_rng(4)
    want = {}
    for name, width in (("a.bin", 2), ("b.bin", 2)):
        ids = rng.integers(0, 6, 997).astype("<u2")
        (tmp_path / name).write_bytes(ids.tobytes())
        ends = np.flatnonzero(ids == 0)
        want[name] = list(np.diff(np.concatenate(([-1], ends))) - 1), 996 - ends[-1]
    blocks = op8.read_token_files(spark, f"file://{tmp_path}", width=2, block_tokens=10)
    got = op8.token_counts(blocks, separator=0, width=2, group=4).collect()
    for name, (closed, rest) in want.items():
        mine = sorted((r.ordinal, r.n_tokens, r.closed) for r in got if r.file.endswith(name))
        assert [n for _, n, c in mine if c] == closed and [n for _, n, c in mine if not c] == ([rest] if rest else [])


def targets_of(sizes):
    """Sources share by weight; excess over three times a source's size is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    out, open_, left = {s: 0.0 for s in names}, set(names), float(sum(sizes.values()))
    while open_ and left > 1e-9:
        unit = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in list(open_):
            out[s] += unit * weight[s]
            if out[s] >= 3 * sizes[s]:
                left += out[s] - 3 * sizes[s]
                out[s] = 3.0 * sizes[s]
                open_.discard(s)
    return out


def test_mix_targets_and_order(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 60)), rng.choice(["a", "a", "a", "a", "b", "c", "é", "", None])) for i in range(600)]
    rows += [(i, "w " * 9, f"tiny{i % 3}") for i in range(600, 606)] + [(700, None, "void"), (701, "", "a"), (None, "w w", "a"), (5, "w w w", "b"), (5, "w w w", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash")).withColumn("key", F.lit("clash"))
    mixed = op9.mix(docs, op9.quality_weights(labels(spark)))
    got = mixed.collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(words(t))
    want = targets_of(sizes)
    taken, longest = Counter(), Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken // r.size in (int(r.target // r.source_size), int(r.target // r.source_size) + 1))
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
    assert len(got) == len(rows) and all(abs(taken[s] - want[s]) <= longest[s] / 2 + 1e-6 for s in sizes)
    again = op9.mix(docs.repartition(7), op9.quality_weights(labels(spark))).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert op9.mix(empty_docs(spark), op9.quality_weights(labels(spark))).count() == 0


def test_mix_prefers_quality(spark):
    docs = spark.createDataFrame([(i, "w w w w", "a" if i < 2000 else "b") for i in range(2600)], "doc_id long, text string, source string")
    weights = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, 1.0).otherwise(0.25).alias("weight"))
    got = op9.mix(docs, weights).where("source = 'a'").groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.sum("taken").alias("n")).collect()
    n = {r.odd: r.n for r in got}
    assert n[0] > 1.5 * n[1]


def test_classifier_held_out_accuracy(spark):
    docs, lab = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    stats = op10.text_stats(docs)
    rows = op10.score(stats, op10.train(stats, lab)).join(lab, "doc_id").where(op10.fold(F.col("doc_id")) == 0).collect()
    pos, neg = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > 0.97 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([(r.score >= op10.CUTOFF) == (r.quality == 1) for r in rows]) > 0.95


def test_classifier_cases(spark):
    docs = awkward_docs(spark)
    for lab in (labels(spark), labels(spark).limit(0), labels(spark).where("quality = 1")):
        got = op10.classify(docs, lab)
        assert got.count() == len(awkward_texts()) and got.where("score is null or score < 0 or score > 1").count() == 0
        twins = {r.score for r in got.where("doc.doc_id = 12").collect()}
        assert len(twins) == 1
    assert op10.classify(empty_docs(spark), labels(spark)).count() == 0
    x, y = op10.isotonic(np.array([0.0, 1, 2, 3]), np.array([1.0, 0, 3, 5]), np.array([2.0, 2, 4, 5]))
    assert list(x) == [0.5, 2, 3] and list(y) == pytest.approx([1.5 / 5, 3.5 / 5, 5.5 / 6])


def test_fold_is_crc32_of_the_id(spark):
    import zlib

    got = spark.range(50).select("id", op10.fold(F.col("id")).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in got)


def test_pipeline_stages(spark, tmp_path):
    """The rows of run() against plain Python over the classifier's decisions."""
    import re

    src = {n: table(spark, SF01, n) for n in ("documents", "labels", "benchmark")}
    docs = src["documents"].where("doc_id < 260")
    docs = docs.unionByName(spark.createDataFrame([(9001, None, "en", None, None), (9002, "", None, "src1", 0), (9003, 'word token = "abcdefgh" ' + "x " * 80, "en", "src1", 104)], docs.schema))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for n in ("labels", "benchmark"):
        src[n].write.parquet(f"{tmp_path}/{n}.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, f"file://{tmp_path}").collect()}
    docs = table(spark, f"file://{tmp_path}", "documents")
    judged = op10.classify(docs, src["labels"]).where("predicted = 1").select("doc.doc_id", "doc.text", "doc.source").collect()
    rows = [(r.doc_id, r.text) for r in judged]
    classes, _ = brute_classes(rows)
    keep = {c for d, c, _ in classes if d == c}
    norm = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    wins = {tuple(w[i : i + min(10, len(w))]) for b in src["benchmark"].collect() for w in [norm(b.text)] for i in range(max(1, len(w) - 9))}
    clean = {}
    for d, t in rows:
        w = norm(t)
        if d in keep and not any(tuple(w[i : i + n]) in wins for n in {len(x) for x in wins} for i in range(len(w) - n + 1)):
            text = re.sub(r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{6,})""", "[SECRET]", t or "")
            clean[d] = len(words(text))
    assert {d: r["size"] for d, r in got.items()} == clean
    source = {r.doc_id: r.source for r in judged}
    sizes = Counter()
    for d, n in clean.items():
        sizes[source[d]] += n
    want = targets_of(sizes)
    assert all(r.target == pytest.approx(want[r.source]) for r in got.values())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "jaccard_join", "benchmark_decontamination", "secret_scan", "mix_sources"]


def test_pipeline_on_clashing_and_empty_documents(spark):
    for docs in (awkward_docs(spark), empty_docs(spark)):
        out = docs
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, SF01)
            if name != "mix_sources":
                assert out.columns == docs.columns
        assert (out.count() > 0) == (docs.count() > 0)
