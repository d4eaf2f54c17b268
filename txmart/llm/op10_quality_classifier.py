"""Quality classifier: random Fourier features, ridge by normal equations, isotonic scores.

* ``statistics`` turns every whole text into a fixed vector of document statistics (no
  label, language, source or id among them) in one Arrow map over the scan.
* ``train`` joins the vectors with the labels of folds 1..4 (``crc32(doc_id) mod 5``; fold
  0 is held out). Folds 1..3 fit: standardised vectors are mapped to ``features`` random
  cosines, which approximate a Gaussian kernel, and every partition sums its share of the
  normal equations; the sums are added group-wise on the executors, so the driver gets one
  (features+1)-square matrix whatever the corpus. Fold 4 calibrates: raw scores are counted
  in fixed bins and the pool-adjacent-violators fit runs over those bins.
* ``score`` applies the model: a calibrated probability of label 1 per document.

All labelled rows of the training folds are used; only the model (constant size) passes
through the driver. Defined cases: null text counts as empty and is scored like any other;
several label rows of one document: their mean decides (ties count as 1), null labels are
ignored; a null doc_id falls in fold 0 (crc32 of the empty text) and is never learned from;
no usable label at all: every score is 0.5; one class only: its smoothed rate; repeated
documents give repeated rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txmart.llm.common import gram_hashes, materialize, record_batch, register, table, to_arrow_schema, word_hashes

FOLDS = 5
CUTOFF = 0.3
FEATURES = 256
BINS = 2048
N_STATS = 24

_CLASS = np.zeros(256, dtype=np.int64)  # 0: other ASCII
for _b in range(256):
    _CLASS[_b] = (
        1 if 0x61 <= _b <= 0x7A else 2 if 0x41 <= _b <= 0x5A else 3 if 0x30 <= _b <= 0x39 else 4 if _b in (0x20, 0x09, 0x0B, 0x0C, 0x0D)
        else 5 if _b == 0x0A else 6 if _b in b".,;:?'\"" else 7 if _b in b"#*$%&|<>" else 8 if _b == 0x21 else 9 if _b >= 0x80 else 0
    )


def text_statistics(text: str | None) -> np.ndarray:
    """The statistics of one text: sizes (log), shares of character classes, word and line
    shape, and shares of repeated words, three-word runs and lines."""
    data = b"" if text is None else text.encode("utf-8", "surrogatepass")
    out = np.zeros(N_STATS)
    if not data:
        return out
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    size = len(data)
    kinds = np.bincount(_CLASS, weights=counts, minlength=10)
    words = word_hashes(data)
    n = len(words)
    out[0], out[1] = np.log1p(size), np.log1p(n)
    out[2:12] = np.sqrt(kinds / size)
    p = counts[counts > 0] / size
    out[12] = -(p * np.log(p)).sum()
    letters = kinds[1] + kinds[2]
    out[13] = kinds[2] / letters if letters else 0
    if n:
        inner = size - kinds[4] - kinds[5]
        out[14] = np.log1p(inner / n)
        _, times = np.unique(words, return_counts=True)
        out[15] = len(times) / n
        out[16] = times.max() / n
        grams = gram_hashes(words, 3)
        out[17] = 1 - len(np.unique(grams)) / len(grams) if len(grams) else 0
        out[18] = np.sqrt(min(4.0, kinds[7] / n))
        out[19] = np.sqrt(min(4.0, kinds[8] / n))
        out[20] = np.sqrt(min(4.0, kinds[6] / n))
    lines = [x for x in data.split(b"\n") if x.strip()]
    if lines:
        out[21] = 1 - len(set(lines)) / len(lines)
        out[22] = np.log1p(size / len(lines))
        out[23] = np.log1p(len(lines))
    return out


def fold(doc_id):
    """crc32 of the id as text, modulo the number of folds (null: as the empty text)."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS).cast("int")


def statistics(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc`` (its row, as a struct, so no column name can clash) and
    ``stats`` array<double>."""
    picked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    schema = T.StructType(picked.schema.fields + [T.StructField("stats", T.ArrayType(T.DoubleType()))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield record_batch([b.column(0), [text_statistics(t) for t in b.column(0).field("text").to_pylist()]], arrow)

    return picked.mapInArrow(run, schema)


def text_stats(docs: DataFrame) -> DataFrame:
    """``doc_id, stats`` of every document, written once to the shared folder."""
    return materialize(statistics(docs.select("doc_id", "text")).select("doc.doc_id", "stats"), "stats")


@dataclass(frozen=True)
class Model:
    """Standardisation, random frequencies, ridge weights and the calibration curve."""

    mean: np.ndarray
    scale: np.ndarray
    freq: np.ndarray
    phase: np.ndarray
    weight: np.ndarray
    curve_x: np.ndarray
    curve_y: np.ndarray
    prior: float | None = None  # set when there was nothing to fit

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        out = np.cos(z @ self.freq + self.phase) * np.sqrt(2 / len(self.phase))
        return np.hstack([out, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weight

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(stats), self.prior)
        return np.interp(self.raw(stats), self.curve_x, self.curve_y)


def isotonic(x: np.ndarray, ones: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over binned scores: block centres and smoothed rates."""
    blocks: list[list[float]] = []
    for xi, si, ni in zip(x, ones, n):
        blocks.append([xi * ni, si, ni])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    centre = np.array([b[0] / b[2] for b in blocks])
    rate = np.array([(b[1] + 0.5) / (b[2] + 1.0) for b in blocks])
    return centre, np.maximum.accumulate(rate)


def label_table(labels: DataFrame) -> DataFrame:
    """One row per labelled document: ``doc_id, y`` in 0/1."""
    return (
        labels.where("quality is not null and doc_id is not null").groupBy("doc_id")
        .agg(F.avg(F.col("quality").cast("double")).alias("y")).select("doc_id", F.when(F.col("y") >= 0.5, 1.0).otherwise(0.0).alias("y"))
    )


def train(stats: DataFrame, labels: DataFrame, features: int = FEATURES, ridge: float = 1e-3, gamma: float | None = None, seed: int = 11) -> Model:
    """Fit on folds 1..3 and calibrate on fold 4 of the labelled documents."""
    spark = stats.sparkSession
    known = materialize(
        stats.join(label_table(labels), "doc_id").select("doc_id", "stats", "y", fold(F.col("doc_id")).alias("fold")).where("fold <> 0"), "labelled"
    )
    fit = known.where("fold <> 4")
    sums = [F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(N_STATS)] + [F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(N_STATS)]
    row = fit.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("rate"), *sums).first()
    empty = np.zeros(0)
    if not row["n"] or row["rate"] in (0.0, 1.0):
        prior = 0.5 if not row["n"] else (row["rate"] * row["n"] + 0.5) / (row["n"] + 1)
        return Model(empty, empty, empty, empty, empty, empty, empty, float(prior))
    mean = np.array([row[f"m{i}"] for i in range(N_STATS)])
    spread = np.array([row[f"s{i}"] for i in range(N_STATS)])
    scale = np.where(spread > 1e-9, spread, 1.0)
    rng = np.random.default_rng(seed)
    width = gamma if gamma is not None else 1.0 / np.sqrt(N_STATS)
    freq = rng.normal(scale=width, size=(N_STATS, features))
    phase = rng.uniform(0, 2 * np.pi, features)
    shape = Model(mean, scale, freq, phase, empty, empty, empty)
    parts = min(512, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    width1, step = features + 1, 8

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, part = np.zeros((width1, width1 + 1)), 0
        for pdf in batches:
            x = shape.features(np.vstack(pdf["stats"].to_numpy()))
            total[:, :width1] += x.T @ x
            total[:, width1] += x.T @ pdf["y"].to_numpy()
            part = int(pdf["part"].iloc[0])
        for lo in range(0, width1, step):
            yield pd.DataFrame({"block": [lo], "part": [part], "sums": [total[lo : lo + step].tobytes()]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = sum(np.frombuffer(b) for b in pdf.sort_values("part")["sums"])
        return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "sums": [rows.tobytes()]})

    summed = (
        fit.select("doc_id", "stats", "y").repartition(parts, "doc_id").sortWithinPartitions("doc_id").select(F.spark_partition_id().alias("part"), "stats", "y")
        .mapInPandas(partial, "block int, part int, sums binary").groupBy("block").applyInPandas(add, "block int, sums binary")
    )
    normal = np.vstack([np.frombuffer(bytes(r["sums"])).reshape(-1, width1 + 1) for r in sorted(summed.collect(), key=lambda r: r["block"])])
    penalty = ridge * row["n"] * np.eye(width1)
    penalty[-1, -1] = 1e-9
    weight = np.linalg.solve(normal[:, :width1] + penalty, normal[:, width1])
    fitted = Model(mean, scale, freq, phase, weight, empty, empty)

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            raw = np.clip(fitted.raw(np.vstack(pdf["stats"].to_numpy())), -1, 2)
            yield pd.DataFrame({"bin": ((raw + 1) / 3 * (BINS - 1)).astype(int), "y": pdf["y"]})

    calibration = known.where("fold = 4") if known.where("fold = 4").limit(1).count() else fit
    bins = calibration.select("stats", "y").mapInPandas(binned, "bin int, y double").groupBy("bin").agg(F.sum("y").alias("ones"), F.count(F.lit(1)).alias("n")).orderBy("bin").collect()
    at = np.array([r["bin"] for r in bins]) / (BINS - 1) * 3 - 1
    curve = isotonic(at, np.array([r["ones"] for r in bins]), np.array([float(r["n"]) for r in bins]))
    return Model(mean, scale, freq, phase, weight, *curve)


def score(stats: DataFrame, model: Model) -> DataFrame:
    """``stats`` rows with ``score`` (probability of label 1) in place of the vector."""
    schema = T.StructType([f for f in stats.schema.fields if f.name != "stats"] + [T.StructField("score", T.DoubleType())])
    at = stats.columns.index("stats")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATS)
            cols = [b.column(i) for i in range(b.num_columns) if i != at]
            yield record_batch(cols + [pa.array(model.score(x))], arrow)

    return stats.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc`` (the row of ``docs``), ``score`` and ``predicted`` (1 from CUTOFF on). The
    vectors are recomputed next to the rows, so texts are never shuffled."""
    model = train(text_stats(docs), labels)
    return score(statistics(docs), model).withColumn("predicted", (F.col("score") >= CUTOFF).cast("int"))


@register("op10_quality_classifier")
def op10_quality_classifier(spark, sf_dir):
    """Every document of the corpus; learned from the labels outside fold 0."""
    stats = text_stats(table(spark, sf_dir, "documents"))
    model = train(stats, table(spark, sf_dir, "labels"))
    return score(stats, model).select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted")
    )
