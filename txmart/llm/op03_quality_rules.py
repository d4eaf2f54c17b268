"""Quality rules with risk-controlled cutoffs (DataFrame functions only).

Word and line statistics of every whole text are computed row by row in one scan. Each rule
compares one statistic with a cutoff. Which cutoff holds in which stratum (language) is
decided on labelled holdout documents: for every rule and every cutoff of a fixed grid the
good documents (label 1) it would reject are counted, and the cutoff is certified when the
exact binomial tail P(Bin(n, alpha / rules) <= rejected) is at most delta / (strata x rules
x grid). So with probability 1 - delta (Bonferroni over every test made) no stratum loses
more than alpha of its good documents. The strictest certified cutoff of a rule is used; a
stratum with too few labels certifies none and loses nothing to the rules.

Only counts per stratum are shuffled (combined map-side); statistics are written once to
the shared folder, without texts. The binomial sum starts at its largest term and runs
downwards over 40 standard deviations, the part that a double can hold.

Defined cases: null text: no words (base_failed); blank lines are no lines; null language:
a stratum of its own; a document with several labels counts as good only if all are 1;
null ids never match a label; repeated rows give repeated results; empty table: no rows;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txmart.llm.common import BLANKS, materialize, register, table

ALPHA = 0.05
DELTA = 0.05
#: fixed values: rule -> cutoffs from lenient to strict; a document fails above the cutoff
GRID = {
    "symbol_share": (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02),
    "dup_line_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "repeat_share": (0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1),
    "bang_share": (1.5, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1, 0.05),
    "upper_share": (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
    "bar_share": (1.0, 0.7, 0.5, 0.4, 0.3, 0.2, 0.1),
    "long_words": (30.0, 25.0, 20.0, 16.0, 14.0, 12.0, 11.0),
}


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row (bound to a lambda variable)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def removed_chars(text: Column, pattern: str) -> Column:
    """Number of characters that match a character class."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def words(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANKS))


def repeated_words(w: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the array ``w``.

    Window hashes are compared first as a set; only when some repeat are they sorted with
    their places, equal neighbours found, and the words they cover counted once."""

    def covered(hashes: Column) -> Column:
        n = F.size(hashes)
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(
            placed,
            lambda s: F.size(
                F.array_distinct(
                    F.flatten(
                        F.transform(
                            F.filter(
                                F.sequence(F.lit(1), n),
                                lambda k: ((k > 1) & (F.get(s, k - 2).getField("h") == F.get(s, k - 1).getField("h")))
                                | ((k < n) & (F.get(s, k).getField("h") == F.get(s, k - 1).getField("h"))),
                            ),
                            lambda k: let(F.get(s, k - 1).getField("i"), lambda p: F.array(p, p + 1, p + 2)),
                        )
                    )
                )
            ),
        )

    def count(ws: Column) -> Column:
        grams = F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(ws) - 2, F.lit(1))),
            lambda i: F.xxhash64(F.get(ws, i - 1), F.get(ws, i), F.get(ws, i + 1)),
        )
        return F.when(F.size(ws) < 4, F.lit(0)).otherwise(
            let(grams, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
        )

    return let(w, count).cast("long")


def measure(docs: DataFrame, carry=()) -> DataFrame:
    """One row per document with the base counts, the rule statistics and ``base_failed``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    solid = F.filter(F.split(text, "\n"), lambda line: F.length(F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))) > 0)
    w = words(F.col("text"))
    base = docs.select(
        "doc_id", "lang", *carry,
        let(w, lambda ws: F.struct(F.size(ws).cast("long").alias("n"), repeated_words(ws).alias("r"))).alias("__w"),
        let(solid, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d"))).alias("__l"),
        F.length(F.regexp_replace(text, BLANKS, "")).cast("long").alias("word_chars"),
        removed_chars(text, r"[#*$%&|<>]").alias("n_symbols"),
        removed_chars(text, r"[A-Z]").alias("__upper"),
        removed_chars(text, r"[!]").alias("__bang"),
        removed_chars(text, r"[|]").alias("__bar"),
    )
    base = base.select(
        "doc_id", "lang", *carry, F.col("__w.n").alias("n_words"), "word_chars", "n_symbols", F.col("__l.d").alias("n_dup_lines"),
        F.col("__w.r").alias("n_repeat_words"), F.col("__l.n").alias("n_lines"), "__upper", "__bang", "__bar",
    )
    over = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return base.select(
        "doc_id", "lang", *carry, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
        over("n_symbols", "word_chars").alias("symbol_share"), over("n_dup_lines", "n_lines").alias("dup_line_share"),
        over("n_repeat_words", "n_words").alias("repeat_share"), over("__bang", "n_words").alias("bang_share"),
        over("__upper", "word_chars").alias("upper_share"), over("__bar", "n_words").alias("bar_share"),
        over("word_chars", "n_words").alias("long_words"),
    )


def ln_gamma(x: Column) -> Column:
    """log of the gamma function for x >= 1: Stirling's series after a shift by eight."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * F.pow(y, 3)) + 1 / (1260 * F.pow(y, 5)) - 1 / (1680 * F.pow(y, 7))
    shift = sum((F.log(x + i) for i in range(1, 8)), F.log(x))
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + series - shift


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), exact to double precision; 1 when k is at or above the mean."""
    kd, nd = k.cast("double"), n.cast("double")
    top = ln_gamma(nd + 1) - ln_gamma(kd + 1) - ln_gamma(nd - kd + 1) + kd * F.log(F.lit(p)) + (nd - kd) * F.log(F.lit(1 - p))
    steps = F.least(k, F.ceil(40 * F.sqrt(nd * p)) + 100).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def down(acc: Column, i: Column) -> Column:
        term = acc["term"] * (kd - i + 1) / (nd - kd + i) * ((1 - p) / p)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    below = F.when(steps < 1, F.lit(1.0)).otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), start, down, lambda a: a["sum"]))
    return F.when(kd >= nd * p, F.lit(1.0)).otherwise(F.exp(top) * below)


def certify(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, grid: dict = GRID) -> DataFrame:
    """One row per stratum: ``lang`` and the strictest certified cutoff per rule (or null)."""
    good = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1").select(F.col("doc_id").alias("__id"))
    held = measured.where("not base_failed").join(good, F.col("doc_id") == F.col("__id"), "left_semi")
    tests = [(rule, cut) for rule, cuts in grid.items() for cut in cuts]
    counts = held.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.when(F.col(rule) > cut, 1)).alias(f"k{i}") for i, (rule, cut) in enumerate(tests)]
    )
    strata = measured.select("lang").distinct().agg(F.count(F.lit(1)).alias("strata"))
    rows = F.explode(F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(cut).alias("cut"), F.col(f"k{i}").alias("k")) for i, (rule, cut) in enumerate(tests)]))
    tested = counts.crossJoin(F.broadcast(strata)).select("lang", "n", "strata", rows.alias("t")).select("lang", "n", "strata", "t.*")
    passed = binomial_tail(F.col("k"), F.col("n"), alpha / len(grid)) <= F.lit(delta) / (F.col("strata") * len(tests))
    return tested.where(passed).groupBy("lang").agg(*[F.min(F.when(F.col("rule") == rule, F.col("cut"))).alias(f"cut_{rule}") for rule in grid])


def apply_rules(measured: DataFrame, cutoffs: DataFrame, grid: dict = GRID) -> DataFrame:
    """``measured`` with ``failed_rules`` (names) and ``kept``. Cutoffs: one row per stratum."""
    cuts = cutoffs.withColumnRenamed("lang", "__lang")
    joined = measured.join(cuts, F.col("lang").eqNullSafe(F.col("__lang")), "left").drop("__lang")
    failed = F.filter(F.array(*[F.when(F.col(rule) > F.col(f"cut_{rule}"), F.lit(rule)) for rule in grid]), lambda x: x.isNotNull())
    return joined.withColumn("failed_rules", F.array_join(failed, ",")).withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))


def _oracle() -> str:
    tests = [(rule, cut) for rule, cuts in GRID.items() for cut in cuts]
    values = ", ".join(f"('{r}', cast({c} as double))" for r, c in tests)
    return rf"""
with base as (
  select row_number() over () as rid, doc_id, lang, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents),
wins as (select rid, i, array_to_string(w[i : i + 2], ' ') as g from (select rid, w, unnest(range(1, len(w) - 1)) as i from base where len(w) > 2)),
rep as (
  select rid, count(distinct i + k) as r
  from (select rid, i, unnest([0, 1, 2]) as k from (select rid, i, count(*) over (partition by rid, g) as c from wins) where c > 1) group by rid),
m as (
  select rid, doc_id, lang, len(w) as n_words, len(array_to_string(w, '')) as word_chars,
         len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols, len(lines) - len(list_distinct(lines)) as n_dup_lines,
         coalesce(r, 0) as n_repeat_words, len(lines) as n_lines, len(t) - len(regexp_replace(t, '[A-Z]', '', 'g')) as up,
         len(t) - len(regexp_replace(t, '!', '', 'g')) as bang, len(t) - len(regexp_replace(t, '[|]', '', 'g')) as bar
  from base left join rep using (rid)),
s as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
         case when word_chars > 0 then n_symbols / word_chars else 0 end as symbol_share, case when n_lines > 0 then n_dup_lines / n_lines else 0 end as dup_line_share,
         case when n_words > 0 then n_repeat_words / n_words else 0 end as repeat_share, case when n_words > 0 then bang / n_words else 0 end as bang_share,
         case when word_chars > 0 then up / word_chars else 0 end as upper_share, case when n_words > 0 then bar / n_words else 0 end as bar_share,
         case when n_words > 0 then word_chars / n_words else 0 end as long_words
  from m),
long as (select rid, doc_id, lang, base_failed, rule, value from s unpivot (value for rule in (symbol_share, dup_line_share, repeat_share, bang_share, upper_share, bar_share, long_words))),
good as (select doc_id from labels group by doc_id having min(quality) = 1),
tests(rule, cut) as (values {values}),
counts as (
  select l.lang, t.rule, t.cut, count(*) as n, count(*) filter (l.value > t.cut) as k
  from long l join tests t on l.rule = t.rule where not l.base_failed and l.doc_id in (select doc_id from good) group by all),
tail as (
  select lang, rule, cut, sum(exp(lgamma(n + 1.0) - lgamma(j + 1.0) - lgamma(n - j + 1.0) + j * ln({ALPHA} / {len(GRID)}) + (n - j) * ln(1 - {ALPHA} / {len(GRID)}))) as p
  from (select lang, rule, cut, n, unnest(range(0, k + 1)) as j from counts) group by all),
cuts as (
  select lang, rule, min(cut) as cut from tail where p <= {DELTA} / ((select count(*) from (select distinct lang from documents)) * {len(tests)}) group by all),
bad as (select distinct l.rid from long l join cuts c on l.lang is not distinct from c.lang and l.rule = c.rule where l.value > c.cut)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
       cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
       not base_failed and rid not in (select rid from bad) as kept
from s
"""


@register("op3_quality_rules", _oracle())
def op3_quality_rules(spark, sf_dir):
    """Every document; cutoffs certified on all labelled documents."""
    measured = materialize(measure(table(spark, sf_dir, "documents")), "measured")
    result = apply_rules(measured, certify(measured, table(spark, sf_dir, "labels")))
    return result.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
