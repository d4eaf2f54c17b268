"""Shared fixtures of the operator tests: awkward documents and small tables."""

import random

from pyspark.sql import functions as F

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: columns that no operator may trip over
EXTRA = ("h", "rid", "th", "shard", "spans", "score", "stats", "predicted", "size", "key", "part", "n_words", "n_hit", "items", "kept", "taken", "weight", "doc", "g", "bin")


def awkward_texts():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    words = lambda n: [rng.choice(vocab) for _ in range(n)]
    base = words(120)
    passage = words(30)
    near = list(base)
    near[60] = "changed"
    out = [
        (1, " ".join(base)), (2, " ".join(base)), (3, " ".join(near)), (4, None), (5, ""), (6, " \t\n "), (7, "one"), (8, "one two three four"),
        (9, " ".join(words(40) + passage + words(25))), (10, "\n".join([" ".join(words(10)), " ".join(passage), " ".join(words(12))])),
        (11, "Ünïcode " * 30 + "token = \"abcdef0123456789\" é"), (12, " ".join(passage * 3)), (12, " ".join(passage * 3)),
        (None, " ".join(words(60))), (None, None), (13, "x\x00y\x85z\xa0w " * 8), (14, " ".join(words(6000))), (15, "same same same same " * 20),
        (16, "SHOUT!! " * 60), (17, " ".join(base[:100] + words(3) + base[100:])),
    ]
    return out


def awkward_docs(spark, extra=True):
    rows = [(i, t, None if k % 5 == 0 else "en" if k % 2 else "de", None if k % 7 == 0 else f"src{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(awkward_texts())]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    for name in EXTRA if extra else ():
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def labels(spark):
    rows = [(1, 1, 0), (2, 0, 0), (3, 1, 0), (9, 1, 0), (9, 0, 1), (10, None, 0), (None, 1, 0), (14, 1, 0), (16, 0, 0), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("weight", F.lit("clash"))


def words(text):
    return [] if text is None else text.encode().split()
