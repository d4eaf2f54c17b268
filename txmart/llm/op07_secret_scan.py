"""Secret scans with multipart credential linking (DataFrame functions only).

Strong kinds are reported wherever they match (``assign``, ``access``, ``hex``). Weak kinds
mean little alone and are reported only when complementary parts stand in the same scope,
that is within ``reach`` code points of the same document:

* ``bare``: a run of 20+ token characters with a digit and both letter cases: an identifier
  (``access`` or ``ident``) must be in scope;
* ``ident``: a user, login or client id assignment: a secret (``assign``, ``hex``, ``bare``)
  must be in scope;
* ``endpoint``: a url with a scheme: an identifier and a secret must be in scope.

Match offsets come from the pieces between matches: piece and match lengths are exploded
(only for documents that match anything) and summed by a window per document and kind. The
interval join of parts with their complements is a sweep over a document's parts in order
of start: the farthest end before and the nearest start after each part. Windows are bounded
by one document; texts are scanned once and never shuffled, only the short part rows are.

Defined cases: null text counts as empty; documents are told apart by id and text hash, so a
repeated row gets the result of its twin, and a null id is allowed; weak parts that overlap a
strong one, or ``bare`` ones inside an ``endpoint``, are dropped; ties in start go by kind in
the order of ``KINDS``; empty table: no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txmart.llm.common import register, table

REACH = 200
#: fixed values: kinds in report order, and their patterns
STRONG = ("assign", "access", "hex")
KINDS = (*STRONG, "bare", "ident", "endpoint")
PATTERNS = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "bare": r"[A-Za-z0-9+/_-]{20,}",
    "ident": r"""(?i)(?:username|user_id|userid|user|login|client_?id|account_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""",
    # a scheme has at most 32 characters here: without a bound, a long run of letters costs its square
    "endpoint": r"""[A-Za-z][A-Za-z0-9+.-]{0,31}://[^\x20\x09-\x0D"'<>]+""",
}
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
IDENT_WORDS = ("user", "login", "client", "account")

_EMPTY = "array<struct<kind:int,i:int,gap:int,size:int,ok:boolean>>"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row (bound to a lambda variable)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def pieces(text: Column, kind: str) -> Column:
    """The matches of a kind with the length of the text before each (since the last one)."""
    pattern, no = F.lit(PATTERNS[kind]), KINDS.index(kind)
    if kind == "assign":
        values = F.regexp_extract_all(text, pattern, F.lit(2))
        ok = lambda x, i, v: F.length(F.get(v, i)) >= 6
    elif kind == "bare":
        values = F.array().cast("array<string>")
        ok = lambda x, i, v: x.rlike("[0-9]") & x.rlike("[a-z]") & x.rlike("[A-Z]")
    else:
        values = F.array().cast("array<string>")
        ok = lambda x, i, v: F.lit(True)
    row = lambda x, i, s, v: F.struct(
        F.lit(no).alias("kind"), i.alias("i"), F.length(F.get(s, i)).alias("gap"), F.length(x).alias("size"), ok(x, i, v).alias("ok")
    )
    found = let(
        F.regexp_extract_all(text, pattern, F.lit(0)),
        lambda m: F.when(F.size(m) == 0, F.array().cast(_EMPTY)).otherwise(
            let(F.split(text, PATTERNS[kind], -1), lambda s: let(values, lambda v: F.transform(m, lambda x, i: row(x, i, s, v))))
        ),
    )
    return found


def _any(text: Column, words) -> Column:
    hit = F.lit(False)
    for w in words:
        hit = hit | text.contains(w)
    return hit


def matches(docs: DataFrame) -> DataFrame:
    """Rows ``doc_id, h, kind, start, end`` of every strong and weak match, one set per
    distinct (doc_id, text). Cheap substring tests come before each pattern."""
    none = F.array().cast(_EMPTY)
    text = F.col("__t")
    guards = {
        "assign": F.col("__a"), "access": text.contains("AKIA"), "hex": F.lit(True), "ident": F.col("__i"),
        "endpoint": text.contains("://") & (F.col("__i") | F.col("__a") | text.contains("AKIA") | text.rlike("[0-9a-f]{24}")),
        "bare": F.col("__i") | text.contains("AKIA"),
    }
    flags = let(F.lower(F.coalesce("text", F.lit(""))), lambda low: F.struct(_any(low, ASSIGN_WORDS).alias("a"), _any(low, IDENT_WORDS).alias("i")))
    seen = docs.select("doc_id", text_key(F.col("text")).alias("h"), F.coalesce("text", F.lit("")).alias("__t"), flags.alias("__f"))
    seen = seen.select("doc_id", "h", "__t", F.col("__f.a").alias("__a"), F.col("__f.i").alias("__i"))
    found = seen.select("doc_id", "h", F.concat(*[F.when(guards[k], pieces(text, k)).otherwise(none) for k in KINDS]).alias("parts"))
    found = found.where(F.size("parts") > 0).dropDuplicates(["doc_id", "h"])
    rows = found.select("doc_id", "h", F.explode("parts").alias("p")).select("doc_id", "h", "p.*")
    run = Window.partitionBy("doc_id", "h", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("size")).over(run)
    return rows.withColumn("end", end).where("ok").select("doc_id", "h", "kind", (F.col("end") - F.col("size")).alias("start"), "end")


def link(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """Strong parts, and the weak ones whose complements are in scope."""
    of = lambda *names: F.col("kind").isin(*[KINDS.index(n) for n in names])
    order = Window.partitionBy("doc_id", "h").orderBy("start", "kind", "end")
    # what comes after is a running minimum from the end: a frame that ends unbounded would be
    # added up anew for every part, the square of a document's parts
    back = Window.partitionBy("doc_id", "h").orderBy(F.desc("start"), F.desc("kind"), F.desc("end"))
    before, after = (w.rowsBetween(Window.unboundedPreceding, -1) for w in (order, back))

    def near(kinds: Column, gap: int) -> Column:
        """Does a part of these kinds end after start - gap and start before end + gap?"""
        left = F.max(F.when(kinds, F.col("end"))).over(before) > F.col("start") - gap
        right = F.min(F.when(kinds, F.col("start"))).over(after) < F.col("end") + gap
        return F.coalesce(left, F.lit(False)) | F.coalesce(right, F.lit(False))

    clear = parts.withColumn("strong", near(of(*STRONG), 0)).withColumn("url", near(of("endpoint"), 0))
    clear = clear.where(of(*STRONG) | (~F.col("strong") & ~(of("bare") & F.col("url")))).drop("strong", "url")
    identifier, secret = near(of("access", "ident"), reach), near(of("assign", "hex", "bare"), reach)
    marked = clear.withColumn("__id", identifier).withColumn("__sec", secret)
    keep = of(*STRONG) | (of("bare") & F.col("__id")) | (of("ident") & F.col("__sec")) | (of("endpoint") & F.col("__id") & F.col("__sec"))
    return marked.where(keep).select("doc_id", "h", "kind", "start", "end")


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per (doc_id, text) that has secrets: ``doc_id, h, spans`` (sorted structs
    ``start, kind, end``; kind indexes ``KINDS``)."""
    spans = F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans")
    return link(matches(docs), reach).groupBy("doc_id", "h").agg(spans)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    text = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, text), ",")


def attach(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``doc`` (the row of ``docs``, as a struct, so no column name can clash) and its
    ``spans`` (null: none)."""
    own = found.select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"), "spans")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), text_key(F.col("text")).alias("__k"))
    return whole.join(own, F.col("doc.doc_id").eqNullSafe(F.col("__id")) & (F.col("__k") == F.col("__h")), "left").select("doc", "spans")


def redact(docs: DataFrame, mark: str = "[SECRET]", reach: int = REACH) -> DataFrame:
    """``docs`` with every reported span replaced by ``mark`` (overlapping ones by one mark)
    and ``n_chars`` recounted; texts without secrets stay as they are."""
    found = link(matches(docs), reach)
    order = Window.partitionBy("doc_id", "h").orderBy("start", "kind", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    found = found.withColumn("__new", F.when(reached.isNull() | (F.col("start") > reached), 1).otherwise(0))
    found = found.withColumn("__g", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = found.groupBy("doc_id", "h", "__g").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    cuts = merged.groupBy("doc_id", "h").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    joined = attach(docs, cuts)
    text = F.col("doc.text")
    part = lambda k: let(
        F.when(k == 0, F.lit(0)).otherwise(F.get(F.col("spans"), k - 1)["end"]),
        lambda at: F.substring(text, (at + 1).cast("int"), (F.coalesce(F.get(F.col("spans"), k)["start"], F.length(text)) - at).cast("int")),
    )
    new = F.array_join(F.transform(F.sequence(F.lit(0), F.size("spans")), part), mark)
    joined = joined.withColumn("__new", F.when(F.col("spans").isNull(), text).otherwise(new))
    recount = F.when(F.col("spans").isNull(), F.col("doc.n_chars")).otherwise(F.length("__new").cast("long")) if "n_chars" in docs.columns else None
    changed = {"text": F.col("__new"), "n_chars": recount}
    return joined.select(*[(changed[c] if c in changed else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def _oracle() -> str:
    q = {k: v.replace("'", "''") for k, v in PATTERNS.items()}
    one = " union all ".join(
        f"""select rid, {i} as kind, unnest(range(1, len(regexp_extract_all(t, '{q[k]}')) + 1)) as i, regexp_extract_all(t, '{q[k]}') as m,
        string_split_regex(t, '{q[k]}') as s, {"regexp_extract_all(t, '" + q[k] + "', 2)" if k == "assign" else "[]::varchar[]"} as v from d"""
        for i, k in enumerate(KINDS)
    )
    return rf"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
raw as ({one}),
ends as (
  select rid, kind, len(m[i]) as size, sum(len(s[i]) + len(m[i])) over (partition by rid, kind order by i) as e,
         case kind when 0 then len(v[i]) >= 6 when 3 then regexp_matches(m[i], '[0-9]') and regexp_matches(m[i], '[a-z]') and regexp_matches(m[i], '[A-Z]') else true end as ok
  from raw),
parts as (select rid, kind, cast(e - size as bigint) as s, cast(e as bigint) as e from ends where ok),
clear as (
  select * from parts p where kind < 3 or not exists (
    select 1 from parts q where q.rid = p.rid and (q.kind < 3 or (p.kind = 3 and q.kind = 5)) and q.e > p.s and q.s < p.e)),
kept as (
  select * from clear p where kind < 3
    or (kind in (3, 5) and exists (select 1 from clear q where q.rid = p.rid and q.kind in (1, 4) and q.e > p.s - {REACH} and q.s < p.e + {REACH})
        and (kind = 3 or exists (select 1 from clear q where q.rid = p.rid and q.kind in (0, 2, 3) and q.e > p.s - {REACH} and q.s < p.e + {REACH})))
    or (kind = 4 and exists (select 1 from clear q where q.rid = p.rid and q.kind in (0, 2, 3) and q.e > p.s - {REACH} and q.s < p.e + {REACH}))),
named as (select *, {list(KINDS)!r}[kind + 1] || ':' || s || ':' || e as text from kept),
agg as (
  select rid, count(*) filter (kind = 0) as a, count(*) filter (kind = 1) as c, count(*) filter (kind = 2) as x,
         string_agg(text, ',' order by s, kind, e) filter (kind < 3) as base, string_agg(text, ',' order by s, kind, e) as spans
  from named group by rid)
select doc_id, cast(coalesce(a, 0) as bigint) as n_assign, cast(coalesce(c, 0) as bigint) as n_access, cast(coalesce(x, 0) as bigint) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join agg using (rid)
"""


@register("op7_secret_scan", _oracle())
def op7_secret_scan(spark, sf_dir):
    """Every whole text of the documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = attach(docs, scan(docs))
    spans = F.coalesce(F.col("spans"), F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(k))).cast("long")
    base = F.filter(spans, lambda s: s["kind"] < len(STRONG))
    return rows.select(
        "doc.doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans"),
    )
