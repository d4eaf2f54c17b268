"""Training-corpus pipeline: five operators of ``txmart.llm`` in a row.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps; ``run`` writes every
stage's rows as Parquet to the shared checkpoint folder and reads them back as the next
stage's documents, so a lost executor costs at most one stage's tasks. All stages but the
last return the columns of ``documents``:

1. ``quality_classifier``: documents that the classifier rejects (score below its cutoff) go;
2. ``jaccard_join``: one document of every class of near copies stays (the least id);
3. ``benchmark_decontamination``: documents with a passage of a benchmark item go;
4. ``secret_scan``: reported secrets are replaced by a mark, ``n_chars`` is recounted;
5. ``mix_sources``: one row per remaining document with the words the mix takes of it.

Empty documents tables pass through every stage as empty tables; nulls, repeated rows and
extra columns are handled as the operators' docstrings say. The classifier is not
expressible in SQL, so there is no oracle; tests compare with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmart.llm import op02_jaccard_join as jaccard
from txmart.llm import op06_decontaminate as decontaminate
from txmart.llm import op07_secret_scan as secrets
from txmart.llm import op09_mix_sources as mixing
from txmart.llm import op10_quality_classifier as quality
from txmart.llm.common import materialize, table

ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = quality.classify(docs, table(spark, sf_dir, "labels"))
    return scored.where(F.col("predicted") == 1).select("doc.*")


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.deduplicate(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"), with_spans=False)
    return found.where(F.col("n_hit") == 0).select("doc.*")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, mixing.quality_weights(table(spark, sf_dir, "labels")))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("jaccard_join", jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
