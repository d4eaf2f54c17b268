"""PII: labelers vote on candidate spans, expectation-maximisation weighs them, a span
classifier trained on its posteriors decides.

1. ``scan_text`` finds per text the base spans (exact patterns of emails, ip numbers, card
   numbers and phones, each in one linear pass) and wider candidates: written-out or spaced
   emails, IPv6 and defanged addresses, cards with other separators or lengths, national
   phone numbers, and base matches that fail their check. Seven labelers vote yes, no or
   nothing on every candidate: strict pattern, arithmetic validity, gazetteer (top-level
   domains, calling codes, issuers, address ranges), words before, characters around, variety
   of the digits, base spans of other kinds. A candidate carries its votes as one number and its features as another.
2. Votes are counted by Spark: at most 4 kinds x 3**7 vote patterns exist, whatever the
   corpus. Expectation-maximisation over these counts estimates for each kind how often it
   is true and how each labeler votes on true and on false spans; a candidate's posterior
   follows from its pattern.
3. Posteriors are summed by Spark per feature cell (at most ``CELLS``, by construction),
   and a ridge logistic regression over one-hot features is fitted to these sums by Newton's
   method: the final classifier sees the span, not the votes, so it also judges where
   labelers abstain.
4. Candidates whose cell scores ``threshold`` or more and that overlap no base span and no
   better candidate are added to the base spans.

All counts cover all documents; what the driver and the workers hold is bounded by the
numbers above. Documents are never shuffled.

Defined cases: null or empty text: no spans; very long runs of any character: linear; ties
between overlapping candidates: the earlier, then the longer; no candidates at all: only
base spans; repeated rows and null ids are documents like any other; extra columns travel in
``doc``; empty table: no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txmart.llm.common import materialize, record_batch, register, table, to_arrow_schema

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
YES, NO = 1, 2  # 0: the labeler says nothing
THRESHOLD = 0.8
FOUND = "base array<struct<kind:int,start:int,end:int>>, candidates array<struct<kind:int,start:int,end:int,votes:int,cell:int>>"

# ---------------------------------------------------------------- base spans

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# a first character class lets the search skip; the look behind keeps it off a run's middle
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def digits(text: str) -> str:
    return _NO_DIGIT.sub("", text)


def luhn(number: str) -> bool:
    values = [ord(c) - 48 for c in reversed(number)]
    return (sum(values[0::2]) + sum(v * 2 - 9 * (v > 4) for v in values[1::2])) % 10 == 0


def small_parts(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping emails: a local part is a run that ends at an ``@``, so each
    ``@`` is looked at once, back to the one before it and on to the end of its domain."""
    done, sign = 0, text.find("@")
    while sign >= 0:
        start = sign - _LOCAL.match(text[done:sign][::-1]).end()
        domain = _DOMAIN.match(text, sign + 1) if start < sign else None
        done = domain.end() if domain else sign + 1
        if domain:
            yield start, done
        sign = text.find("@", done)


def base_matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(kind, start, end, holds): all base matches, and whether each passes its check."""
    for start, end in emails(text):
        yield EMAIL, start, end, True
    for m in _IP.finditer(text):
        yield IP, m.start(), m.end(), small_parts(m.group().split("."))
    for m in _CARD.finditer(text):
        number = digits(m.group())
        if len(number) >= 12:
            yield CARD, m.start(), m.end(), 16 <= len(number) <= 19 and luhn(number)
    for m in _PHONE.finditer(text):
        yield PHONE, m.start(), m.end(), 8 <= len(digits(m.group())) <= 15


# ---------------------------------------------------------------- candidates

_SIGN = re.compile(r"@|＠|[\[({] ?[aA][tT] ?[\])}]")
_BEFORE = re.compile(r" {0,2}[A-Za-z0-9._%+-]{1,64}+")
_AFTER = re.compile(r" {0,2}[A-Za-z0-9-]{1,63}+(?:(?:\.| {0,2}[\[({] ?(?:\.|[dD][oO][tT]) ?[\])}] {0,2})[A-Za-z0-9-]{1,63}+){0,8}")
_IP_WIDE = re.compile(r"[0-9](?<![\w.][0-9])[0-9]{0,2}(?:(?:\.|[\[(](?:\.|dot)[\])])[0-9]{1,3}){3}(?!\w)")
_IP6 = re.compile(r"[0-9A-Fa-f:](?<![\w:.][0-9A-Fa-f:])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:])")
_CARD_WIDE = re.compile(r"[0-9](?<!\w[0-9])(?:[ ./ -]{0,2}[0-9]){12,18}(?![0-9])")
_PHONE_WIDE = re.compile(r"[+(0-9](?<![\w.+(][+(0-9])[0-9]{0,5}\)?(?:[ ./-]{1,2}\(?[0-9]{1,5}\)?){1,6}(?!\w)")


def wide_matches(text: str) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) of looser forms; every pattern is bounded, so each is linear."""
    for m in _SIGN.finditer(text):
        left = _BEFORE.match(text[max(0, m.start() - 66) : m.start()][::-1])
        right = _AFTER.match(text, m.end()) if left else None
        if right:
            yield EMAIL, m.start() - left.end(), right.end()
    for m in _IP_WIDE.finditer(text):
        if small_parts(re.findall("[0-9]+", m.group())):
            yield IP, m.start(), m.end()
    if "::" in text or text.count(":") > 2:
        for m in _IP6.finditer(text):
            if sum(map(bool, m.group().split(":"))) >= 3 and any(c.isdigit() for c in m.group()):
                yield IP, m.start(), m.end()
    for m in _CARD_WIDE.finditer(text):
        yield CARD, m.start(), m.end()
    for m in _PHONE_WIDE.finditer(text):
        if 7 <= len(digits(m.group())) <= 15:
            yield PHONE, m.start(), m.end()


# ---------------------------------------------------------------- labelers

#: fixed values: top-level domains, calling codes, words before a span of each kind, words
#: before numbers that are something else
DOMAINS = frozenset("com org net edu gov mil int info biz io co us uk de fr es it nl be ch at pl pt se no dk fi ie eu ru cn jp kr in br mx ar cl ca au nz za".split())
CALLING = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 351 352 353 358 420 421".split())
CLUES = (
    frozenset("email e-mail mail mailto contact write from to cc correo courriel".split()),
    frozenset("ip ipv4 ipv6 host server address client addr from gateway dns".split()),
    frozenset("card visa mastercard amex credit debit payment tarjeta carte karte".split()),
    frozenset("phone tel telephone call mobile cell fax whatsapp sms telefon teléfono téléphone appelez".split()),
)
OTHER_NUMBERS = frozenset("version v ver isbn issn doi order invoice ref id no nr section figure fig table chapter page pages release build rfc vol".split())
_LAST_WORD = re.compile(r"[^\W\d_](?:[^\W\d_]|[0-9-])*(?=[\s:.#=(\[]*$)")
_SPACED_SIGN = re.compile(r"[ \[({＠]")


def strict_vote(kind: int, span: str, base: bool) -> int:
    if base:
        return YES
    if kind == EMAIL:
        return 0 if re.search(r"[\[({]|＠", span) else NO
    if kind == IP:
        return YES if ":" in span and (span.count(":") == 7 or "::" in span) else 0
    if kind == CARD:
        return YES if re.fullmatch(r"[0-9]{4}([ ./ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5}", span) else 0
    return YES if re.fullmatch(r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}|00[0-9]{1,3}[ .-].*", span) else NO


def valid_vote(kind: int, span: str, number: str) -> int:
    if kind == EMAIL:
        return YES if re.search(r"(?:\.|[dD][oO][tT] ?[\])}] {0,2})[A-Za-z]{2,}$", span) else NO
    if kind == IP:
        return YES if ":" in span or small_parts(re.findall("[0-9]+", span)) else NO
    if kind == CARD:
        return YES if 13 <= len(number) <= 19 and luhn(number) else NO
    return YES if 8 <= len(number) <= 15 else 0


def gazetteer_vote(kind: int, span: str, number: str) -> int:
    if kind == EMAIL:
        return YES if re.split(r"[^a-z0-9-]+", span.lower())[-1] in DOMAINS else NO
    if kind == IP:
        first = re.match("[0-9]+", span)
        return 0 if ":" in span or first is None else NO if int(first.group()[-3:]) in (0, 127, 255) else YES
    if kind == CARD:
        return YES if number[:1] in "3456" and number[:2] not in ("30", "31", "32", "33", "39") else NO
    coded = number.removeprefix("00") if span.startswith("00") else number
    if span.startswith(("+", "00")):
        return YES if any(coded[:n] in CALLING for n in (1, 2, 3)) else NO
    return 0


def before_vote(kind: int, before: str) -> int:
    word = _LAST_WORD.search(before)
    word = word.group().lower() if word else ""
    return YES if word in CLUES[kind] else NO if word in OTHER_NUMBERS or before.rstrip()[-1:] in ("$", "€", "£", "%", "=") else 0


def around_vote(before: str, after: str) -> int:
    if before[-1:].isalnum() or after[:1].isalnum() or re.match(r"[.,/-]?[0-9]", after) or re.search(r"[0-9][.,/-]?$", before):
        return NO
    return YES if not before[-1:].strip(" \t\n([<\"':,;") and not after[:1].strip(" \t\n)]>\"':,;.!?") else 0


def variety_vote(number: str) -> int:
    if len(number) < 4:
        return 0
    steps = {(int(y) - int(x)) % 10 for x, y in zip(number, number[1:])}
    return NO if len(steps) == 1 or len(set(number)) < 3 else YES


LABELERS = 7


def votes_of(kind: int, span: str, base: bool, rival: bool, before: str, after: str) -> list[int]:
    """``rival``: a base span of another kind overlaps the candidate."""
    number = digits(span)
    return [
        strict_vote(kind, span, base), valid_vote(kind, span, number), gazetteer_vote(kind, span, number), before_vote(kind, before), around_vote(before, after), variety_vote(number),
        NO if rival else 0,
    ]


# ---------------------------------------------------------------- features

#: levels of the features within a kind: form, digits, separators, word before, left, right
LEVELS = (4, 4, 4, 3, 3, 3)
CELLS = len(KINDS) * int(np.prod(LEVELS))


def features_of(kind: int, span: str, before: str, after: str) -> list[int]:
    number = digits(span)
    kinds_of = len(set(re.findall(r"[^0-9A-Za-z]", span)))
    if kind == EMAIL:
        form = 1 if re.search(r"[\[({]", span) else 2 if _SPACED_SIGN.search(span) else 3 if "." not in span.partition("@")[2] else 0
    elif kind == IP:
        form = 1 if ":" in span else 2 if re.search(r"[\[(]", span) else 0
    elif kind == CARD:
        form = 0 if number == span else 1 if re.fullmatch("[0-9 -]+", span) else 2
    else:
        form = 0 if span[0] == "+" else 1 if "(" in span else 2 if span.startswith("00") else 3
    edges = (0, 1, 4, 8) if kind == EMAIL else (0, 6, 9, 11) if kind == IP else (0, 14, 16, 17) if kind == CARD else (0, 8, 10, 12)
    edge = lambda c: 0 if not c.strip() else 1 if not c.isalnum() else 2
    return [form, sum(len(number) >= e for e in edges[1:]), min(kinds_of, 3), before_vote(kind, before), edge(before[-1:]), edge(after[:1])]


def code(values: list[int], levels: tuple[int, ...]) -> int:
    out = 0
    for value, n in zip(values, levels):
        out = out * n + value
    return out


def decode(number: int, levels: tuple[int, ...]) -> list[int]:
    out = []
    for n in reversed(levels):
        number, value = divmod(number, n)
        out.append(value)
    return out[::-1]


class Cover:
    """Which kinds of base spans overlap a place (spans of one kind do not overlap)."""

    def __init__(self, base: list[tuple[int, int, int]]):
        self.spans = {k: [(s, e) for kind, s, e in base if kind == k] for k in range(len(KINDS))}

    def overlaps(self, start: int, end: int, but: int | None = None) -> bool:
        for kind, spans in self.spans.items():
            i = bisect_left(spans, (end, -1)) if kind != but else 0
            if i and spans[i - 1][1] > start:
                return True
        return False


@lru_cache(maxsize=1 << 15)
def judged(kind: int, span: str, base: bool, rival: bool, before: str, after: str) -> tuple[int, int]:
    """The votes and the feature cell of a candidate, each as one number."""
    votes = votes_of(kind, span, base, rival, before, after)
    return code(votes, (3,) * LABELERS), code([kind, *features_of(kind, span, before, after)], (len(KINDS), *LEVELS))


def scan_text(text: str | None) -> tuple[list[tuple], list[tuple]]:
    """(base spans, candidates with votes and cell), each in the order of kind and start."""
    if not text:
        return [], []
    found = list(base_matches(text))
    base = sorted((k, s, e) for k, s, e, holds in found if holds)
    holding, taken = set(base), Cover(base)
    candidates = []
    # a number with a part above 255 is no address; other failed base matches are judged too
    for k, s, e in sorted({(k, s, e) for k, s, e, holds in found if holds or k != IP} | set(wide_matches(text))):
        # a base match may be as long as the text; what is judged of one is its first 200 letters
        span, before, after = text[s : min(e, s + 200)], text[max(0, s - 24) : s], text[e : e + 4]
        holds = (k, s, e) in holding
        candidates.append((k, s, e, *judged(k, span, holds, not holds and taken.overlaps(s, e, k), before, after)))
    return base, candidates


# ---------------------------------------------------------------- reliabilities and classifier


def posteriors(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Expectation-maximisation over vote patterns of one kind: P(true) of each pattern.
    ``votes`` is patterns x labelers (0, YES or NO). A labeler has a distribution over its three
    answers on true and one on false spans; pseudo-counts keep both proper and say that a
    labeler is rather right than wrong."""
    answer = votes[:, :, None] == np.arange(3)
    prior = np.array([[2.0, 1.0, 2.0], [2.0, 2.0, 1.0]])  # false, true: no answer, yes, no
    yes, no = (votes == YES).sum(axis=1), (votes == NO).sum(axis=1)
    p = (yes + 1.0) / (yes + no + 2.0)
    for _ in range(rounds):
        log = []
        for truth, share in ((0, 1 - p), (1, p)):
            weight = counts * share
            seen = np.einsum("i,ija->ja", weight, answer) + prior[truth]
            log.append(np.log((weight.sum() + 1) / (counts.sum() + 2)) + np.einsum("ija,ja->i", answer, np.log(seen / seen.sum(axis=1, keepdims=True))))
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        done, p = np.abs(new - p).max() < 1e-9, new
        if done:
            break
    return p


def design(cells: np.ndarray) -> np.ndarray:
    """One-hot features of cells: the kind, and every feature's level within its kind."""
    levels, rows = (len(KINDS), *LEVELS), np.array([decode(int(c), (len(KINDS), *LEVELS)) for c in cells]).reshape(len(cells), len(LEVELS) + 1)
    blocks = [np.eye(levels[0])[rows[:, 0]]]
    blocks += [np.eye(levels[0] * n)[rows[:, 0] * n + rows[:, 1 + i]] for i, n in enumerate(LEVELS)]
    return np.hstack(blocks)


def fit_classifier(cells: np.ndarray, mass: np.ndarray, total: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Scores of the cells under a ridge logistic regression fitted to ``mass`` true of
    ``total`` spans a cell (posterior sums) by Newton steps."""
    x = design(cells)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (total * p * (1 - p))[:, None]) + ridge * np.eye(len(w)), x.T @ (mass - total * p) - ridge * w)
        w += step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))  # long steps are shortened
        if np.abs(step).max() < 1e-8:
            break
    return 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))


def train(candidates: DataFrame) -> dict[int, float]:
    """Score of every feature cell that occurs, from ``candidates(kind, votes, cell)``."""
    spark = candidates.sparkSession
    grid = candidates.groupBy("kind", "votes").count().collect()  # at most 4 x 3**7 rows
    weights = []
    for kind in range(len(KINDS)):
        rows = [r for r in grid if r["kind"] == kind]
        if rows:
            votes = np.array([decode(r["votes"], (3,) * LABELERS) for r in rows])
            p = posteriors(votes, np.array([float(r["count"]) for r in rows]))
            weights += [(kind, r["votes"], float(x)) for r, x in zip(rows, p)]
    if not weights:
        return {}
    table_of = spark.createDataFrame(weights, "kind int, votes int, p double")
    sums = candidates.join(F.broadcast(table_of), ["kind", "votes"]).groupBy("cell").agg(F.sum("p").alias("mass"), F.count(F.lit(1)).alias("total"))
    cells = sums.orderBy("cell").collect()  # at most CELLS rows
    at = np.array([r["cell"] for r in cells])
    scores = fit_classifier(at, np.array([r["mass"] for r in cells]), np.array([float(r["total"]) for r in cells]))
    return dict(zip(at.tolist(), scores.tolist()))


# ---------------------------------------------------------------- over the corpus


def scan(docs: DataFrame) -> DataFrame:
    """``doc`` (the row as a struct), ``base`` spans and ``candidates`` of every document."""
    picked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    schema = T.StructType(picked.schema.fields + T._parse_datatype_string(FOUND).fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan_text(t) for t in batch.column(0).field("text").to_pylist()]
            base = [[dict(zip(("kind", "start", "end"), x)) for x in r[0]] for r in rows]
            wide = [[dict(zip(("kind", "start", "end", "votes", "cell"), x)) for x in r[1]] for r in rows]
            yield record_batch([batch.column(0), base, wide], arrow)

    return picked.mapInArrow(run, schema)


def joined(spans: str) -> F.Column:
    """``kind:start:end`` of an array of spans (in order), comma-joined."""
    kinds = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({spans}, x -> concat(element_at(array({kinds}), x.kind + 1), ':', x.start, ':', x.end)), ',')")


def add_spans(found: DataFrame, scores: dict[int, float], threshold: float = THRESHOLD) -> DataFrame:
    """``found`` (written) with ``spans``: base spans and accepted candidates, by kind and start."""
    good = {cell: s for cell, s in scores.items() if s >= threshold}
    shared = found.sparkSession.sparkContext.broadcast(good)
    schema = T.StructType([*(f for f in found.schema.fields if f.name != "candidates"), T.StructField("spans", found.schema["base"].dataType)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value
        for batch in batches:
            spans = [
                chosen([tuple(b.values()) for b in base], [tuple(c.values()) for c in wide if c["cell"] in score], score)
                for base, wide in zip(batch.column("base").to_pylist(), batch.column("candidates").to_pylist())
            ]
            kept = [batch.column(f.name) for f in arrow if f.name != "spans"]
            yield record_batch([*kept, [[dict(zip(("kind", "start", "end"), x)) for x in s] for s in spans]], arrow)

    return found.mapInArrow(run, schema)


def chosen(base: list[tuple], candidates: list[tuple], score: dict[int, float]) -> list[tuple]:
    """Base spans and the best candidates that overlap neither them nor a better one."""
    taken, out = Cover(base), list(base)
    added: list[tuple[int, int]] = []
    for k, s, e, _, cell in sorted(candidates, key=lambda c: (-score[c[4]], c[1], -c[2])):
        j = bisect_left(added, (e, -1))  # those added do not overlap each other: the last one before e decides
        if taken.overlaps(s, e) or (j and added[j - 1][1] > s):
            continue
        insort(added, (s, e))
        out.append((k, s, e))
    return sorted(out)


def find_pii(docs: DataFrame, threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """One row per document: ``doc`` (its columns, or those named in ``keep``), ``base`` and
    ``spans`` (base spans and those the classifier adds), arrays of ``kind, start, end`` in
    code points, ordered."""
    found = scan(docs)
    if keep is not None:
        found = found.withColumn("doc", F.struct(*[F.col(f"doc.`{c}`") for c in keep]))
    found = materialize(found, "pii-candidates")
    each = found.select(F.explode("candidates").alias("c")).select("c.kind", "c.votes", "c.cell")
    return add_spans(found, train(each), threshold)


@register("op12_pii_spans")
def op12_pii_spans(spark, sf_dir):
    """Personal data of every document: base spans and those the classifier adds."""
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    # as text: a lambda of two parameters gets the element's index in the second
    counts = [F.expr(f"size(filter(base, x -> x.kind = {k}))").cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc.doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
