"""URL filters (DataFrame functions only): host/path rules, else a logistic regression.

* Rules ``host/path`` are allowed or blocked for a host and its subdomains when the path
  starts with the rule's path; the longest rule string wins.
* Every other url is judged by a logistic regression on hashed character n-grams of host
  and path. It is fitted by Spark ML on a small labelled table (bounded, counted first);
  its weights become one constant array, so judging a url is a single projection over the
  scan: no join, no shuffle, and only the url column is read.

Defined cases: null url, or none with ``://``: empty host and path, no rule, judged by the
model's intercept; a host with a port or user part is taken as written; repeated rows give
repeated results; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txmart.llm.common import register, table

DIM = 4096
GRAMS = (3, 4, 5)
MAX_LABELLED = 20_000
BLOCK_FROM = 0.5

RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)

#: fixed values: words of sites to block and of ordinary sites; ``default_labelled`` makes
#: the labelled urls from them, with the same domains, subdomains and paths for both labels
BLOCKED_WORDS = (
    "casino", "poker", "slots", "jackpot", "bets", "betting", "pills", "pharma", "viagra", "adult", "porn", "xxx", "escort", "ads", "adserver", "popup",
    "track", "tracker", "spam", "linkfarm", "payday", "loans", "crack", "warez", "keygen", "cheap", "free", "prize", "win", "replica",
)
ORDINARY_WORDS = (
    "news", "blog", "wiki", "docs", "guide", "library", "museum", "school", "science", "history", "music", "recipes", "garden", "travel", "weather", "forum",
    "theatre", "novels", "poems", "maps", "law", "health", "sport", "nature", "physics", "painting", "cinema", "village", "harbour", "mountain", "letters",
    "report", "station", "ribbon", "thunder", "nation", "orient", "shelter", "handle", "eastern", "winter", "other", "winding", "thread", "tracing", "frequent",
)


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url column; both empty without ``://``."""
    pattern = r"://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, pattern, 1), string.ascii_uppercase, string.ascii_lowercase), F.regexp_extract(text, pattern, 2)


def matching_rule(host: Column, path: Column, rules) -> Column:
    """struct(rule, action) of the longest fitting rule, else null. Rules are a short list
    (configuration): the choice is one CASE expression, longest rule first."""
    found = F.lit(None).cast("struct<rule:string,action:string>")
    for rule, action in sorted(set(rules), key=lambda r: (len(r[0]), r[0])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))).otherwise(found)
    return found


def buckets(host: Column, path: Column, dim: int = DIM, sizes=GRAMS) -> Column:
    """Distinct hash buckets (1..dim) of the n-grams of host and path, each with its own
    prefix and end marks. Binding the marked text to a lambda variable computes it once."""
    def grams(kind: str, text: Column, n: int) -> Column:
        def bucket(t: Column, i: Column) -> Column:
            return (F.pmod(F.xxhash64(F.lit(kind), F.substring(t, i, F.lit(n))), F.lit(dim)) + 1).cast("int")

        def of(t: Column) -> Column:
            return F.transform(F.sequence(F.lit(1), F.greatest(F.length(t) - (n - 1), F.lit(1))), lambda i: bucket(t, i))

        return F.flatten(F.transform(F.array(F.concat(F.lit("^"), text, F.lit("$"))), of))

    each = [grams(kind, text, n) for kind, text in (("h", host), ("p", path)) for n in sizes]
    return F.array_distinct(F.concat(*each))


def fit_weights(labelled: DataFrame, dim: int = DIM, sizes=GRAMS, regularisation: float = 0.02) -> tuple[list[float], float]:
    """Weights and intercept of the regression on ``labelled(url, label)``; the table must be
    small (``MAX_LABELLED`` rows, counted first)."""
    rows = labelled.where("url is not null and label is not null").select("url", F.col("label").cast("double").alias("label"))
    count = rows.count()
    if count > MAX_LABELLED:
        raise ValueError(f"{count} labelled urls; the training table is bounded by {MAX_LABELLED}")
    if rows.select("label").distinct().count() < 2:
        return [0.0] * dim, -1.0
    host, path = host_path(F.col("url"))
    hashed = rows.select("url", "label", buckets(host, path, dim, sizes).alias("b")).coalesce(1).sortWithinPartitions("url", "label")
    dense = F.transform(F.array("b"), lambda b: F.transform(F.sequence(F.lit(1), F.lit(dim)), lambda i: F.array_contains(b, i).cast("double")))[0]
    model = LogisticRegression(regParam=regularisation, standardization=False, maxIter=100).fit(hashed.select(array_to_vector(dense).alias("features"), "label"))
    return [float(x) for x in model.coefficients], float(model.intercept)


def judge(urls: DataFrame, weights: list[float], intercept: float, rules=RULES, block_from: float = BLOCK_FROM) -> DataFrame:
    """``urls`` with ``host, path, rule, score, verdict`` (allow or block)."""
    host, path = host_path(F.col("url"))
    parts = urls.withColumn("host", host).withColumn("path", path)
    table_of = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    logit = F.aggregate(buckets(F.col("host"), F.col("path"), len(weights)), F.lit(float(intercept)), lambda acc, b: acc + F.element_at(table_of, b))
    hit = matching_rule(F.col("host"), F.col("path"), rules)
    scored = parts.withColumn("__hit", hit).withColumn("score", 1 / (1 + F.exp(-logit)))
    verdict = F.coalesce(F.col("__hit.action"), F.when(F.col("score") >= block_from, F.lit("block")).otherwise(F.lit("allow")))
    return scored.withColumn("rule", F.col("__hit.rule")).withColumn("verdict", verdict).drop("__hit")


def default_labelled(spark: SparkSession) -> DataFrame:
    """Four urls per word, among them a compound host; label 1 is to be blocked."""
    tops, fronts, langs = ("com", "net", "org"), ("", "www.", "m.", "blog."), ("en", "fr", "de", "es")
    rows = []
    for label, names in ((1, BLOCKED_WORDS), (0, ORDINARY_WORDS)):
        for i, name in enumerate(names):
            for j, front in enumerate(fronts):
                host = name if j % 2 else f"{name}-{names[(i + j + 1) % len(names)]}"
                rows.append((f"https://{front}{host}.example.{tops[(i + j) % 3]}/{langs[(i + 3 * j) % 4]}/{100 * j + i}", label))
    return spark.sql("select * from values " + ", ".join(f"('{u}', {y})" for u, y in rows) + " as t(url, label)")


@register("op1_url_filter")
def op1_url_filter(spark, sf_dir):
    """Every page's url."""
    weights, intercept = fit_weights(default_labelled(spark))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, weights, intercept).select("page_id", "host", "path", "rule", "verdict", "score")
