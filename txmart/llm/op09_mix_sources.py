"""Mixing sources to target weights by Efraimidis-Spirakis sampling (DataFrame functions only).

Every document gets an exponential key ``-ln(u) / weight``: ``u`` is uniform from the md5
of its id, ``weight`` its quality weight, so reruns agree and better documents come first.
A source's target is its weight's share of all words, at most ``max_epochs`` times its own
words; the excess goes to the other sources by weight (water filling). A source gives
``floor(target / words)`` complete epochs, then whole documents in key order until the rest
of the target is reached; the document that crosses it is taken if that ends nearer, else
skipped for the ones after it.

The prefix sum over a source is distributed: rows are range-partitioned by (source, key),
checkpointed, summed per partition, and only the per-partition sums are scanned before the
window inside each partition. A source with a third of all rows is spread over many
partitions; texts are read once, only to count words.

Defined cases: null or blank text: 0 words, taken 0; null source: a source of its own, last;
null doc_id: key of the empty id; several rows of one id: separate documents, ordered by
size when keys tie; sources without words: target 0; empty table: no rows; several labels
of one document: their mean; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txmart.llm.common import checkpointed, n_words, register, table

MAX_EPOCHS = 3
#: quality weights of documents labelled 1, labelled 0 and not labelled
WEIGHTS = (1.0, 0.25, 0.5)


def quality_weights(labels: DataFrame, weights: tuple = WEIGHTS) -> DataFrame:
    """``doc_id, weight`` from quality labels (the mean of a document's labels)."""
    high, low, _ = weights
    mean = F.avg(F.col("quality").cast("double"))
    return labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.lit(low) + (high - low) * mean).alias("weight"))


def uniform(doc_id: Column, seed: str) -> Column:
    """A number in (0, 1) from 52 bits of the md5 of seed and id."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint").cast("double") + 0.5) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, cycle: tuple = (1, 2, 3), max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: ``source, source_no, source_size, target``.

    Sources rank by code point (null last) and take the weights of ``cycle`` in turn. With
    sources ordered by cap / weight, a source is capped while its cap is at most its share
    of what the capped ones before it leave; the first uncapped one fixes everybody's rate.
    The windows here see one row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    no = F.row_number().over(order)
    weight = F.element_at(F.array(*[F.lit(float(c)) for c in cycle]), ((no - 1) % len(cycle) + 1).cast("int"))
    per = per.select("source", no.alias("source_no"), weight.alias("w"), "source_size", (F.col("source_size") * float(max_epochs)).alias("cap"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), "source_no")
    every = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(every)
    rate = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    per = per.withColumn("rate", rate).withColumn("capped", F.col("cap") <= F.col("rate") * F.col("w"))
    common = F.max(F.when(~F.col("capped"), F.col("rate"))).over(every)  # the first: it falls from there on
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("w") * common)
    return per.select("source", "source_no", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: DataFrame, default_weight: float = WEIGHTS[2], cycle: tuple = (1, 2, 3), max_epochs: int = MAX_EPOCHS, seed: str = "mix") -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken``."""
    spark = docs.sparkSession
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
    known = weights.select(F.col("doc_id").alias("__id"), F.col("weight").alias("__w"))
    key = -F.log(uniform(F.col("doc_id"), seed)) / F.coalesce("__w", F.lit(default_weight))
    sized = checkpointed(sized.join(known, F.col("doc_id") == F.col("__id"), "left").select("doc_id", "source", "size", key.alias("key")))
    targets = source_targets(sized, cycle, max_epochs).withColumnRenamed("source", "__s")
    rows = sized.join(targets, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    in_order = ["source_no", "key", "doc_id", "size"]
    ranged = checkpointed(rows.repartitionByRange(parts, *in_order).withColumn("part", F.spark_partition_id()))
    sums = ranged.groupBy("source_no", "part").agg(F.sum("size").alias("part_size"))
    earlier = Window.partitionBy("source_no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source_no", "part", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source_no", "part").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.join(offsets, ["source_no", "part"]).withColumn("before", F.col("offset") + F.sum("size").over(inside) - F.col("size"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    placed = placed.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    # at most one document per source crosses the rest; if leaving it out ends nearer, the
    # documents after it move up by its size
    crossing = placed.where("before < rest and before + size > rest and 2 * (rest - before) < size").select(F.col("source_no").alias("__n"), F.col("size").alias("skip"))
    placed = placed.join(crossing, F.col("source_no") == F.col("__n"), "left")
    start = F.when(F.col("before") >= F.col("rest"), F.col("before") - F.coalesce("skip", F.lit(0))).otherwise(F.col("before"))
    extra = F.when((F.col("size") > 0) & (2 * (F.col("rest") - start) >= F.col("size")), F.lit(1)).otherwise(F.lit(0))
    return placed.select("doc_id", "source", "size", "source_size", "target", ((F.col("epochs") + extra) * F.col("size")).cast("long").alias("taken"))


ORACLE = r"""
with lab as (select doc_id, 0.25 + 0.75 * avg(cast(quality as double)) as weight from labels where quality is not null and doc_id is not null group by doc_id),
sized as (
  select d.doc_id, d.source, len(regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+')) as size,
         -ln((cast(cast('0x' || substr(md5('mix:' || coalesce(cast(d.doc_id as varchar), '')), 1, 13) as bigint) as double) + 0.5) / 4503599627370496.0)
           / coalesce(lab.weight, 0.5) as key
  from documents d left join lab on d.doc_id = lab.doc_id),
per as (
  select source, row_number() over (order by encode(source) nulls last) as no, cast(sum(size) as double) as source_size from sized group by source),
wt as (select *, cast((no - 1) % 3 + 1 as double) as w, 3.0 * source_size as cap from per),
rated as (
  select *, (sum(source_size) over () - coalesce(sum(cap) over b, 0)) / (sum(w) over () - coalesce(sum(w) over b, 0)) as rate
  from wt window b as (order by cap / w, no rows between unbounded preceding and 1 preceding)),
tgt as (
  select source, no, source_size,
         case when cap <= rate * w then cap else w * max(case when cap > rate * w then rate end) over () end as target
  from rated),
placed as (
  select s.doc_id, s.source, s.size, t.source_size, t.target,
         sum(s.size) over (partition by t.no order by s.key, s.doc_id, s.size rows between unbounded preceding and current row) - s.size as before,
         case when t.source_size > 0 then floor(t.target / t.source_size) else 0 end as epochs
  from sized s join tgt t on s.source is not distinct from t.source),
rest as (select *, target - epochs * source_size as rest from placed),
crossed as (
  select *, case when before >= rest then before - coalesce(max(case when before < rest and before + size > rest and 2 * (rest - before) < size then size end) over (partition by source), 0)
            else before end as start
  from rest)
select doc_id, source, cast(size as bigint) as size, cast(source_size as bigint) as source_size, target,
       cast((epochs + case when size > 0 and 2 * (rest - start) >= size then 1 else 0 end) * size as bigint) as taken
from crossed
"""


@register("op9_mix_sources", ORACLE)
def op9_mix_sources(spark, sf_dir):
    """All documents mixed; quality weights from the labels."""
    return mix(table(spark, sf_dir, "documents"), quality_weights(table(spark, sf_dir, "labels")))
