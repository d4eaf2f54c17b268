"""op1, op3, op4, op6, op7: results against brute force, and the defined odd cases."""

import hashlib
import math
import re
from fractions import Fraction

import numpy as np
import pytest
from llm_cases import awkward_docs, awkward_texts, empty_docs, labels, words

from pyspark.sql import functions as F
from txmart.llm import op01_url_filter as op1
from txmart.llm import op03_quality_rules as op3
from txmart.llm import op04_license_scan as op4
from txmart.llm import op06_decontaminate as op6
from txmart.llm import op07_secret_scan as op7

URLS = [
    None, "", "no-scheme.com/x", "http://example.com/en/1", "https://WWW.Example.com/en/1?x#y", "http://a.b.net/es/", "http://a.net/es", "http://net/fr/2",
    "http://com", "http://com/", "x://y://z/en/", "http://host.org:80/p#f", "http://casino-games.example.org/en/5", "http://Éa.org/ü", "http://q.example.com/en", "http://?a", "http://xnet/es/1",
]


def rule_of(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]) if m else ("", "")
    best = None
    for rule, action in op1.RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest) and (best is None or len(rule) > len(best[0])):
            best = rule, action
    return host, path, best


def test_url_rules_and_model(spark):
    weights, intercept = op1.fit_weights(op1.default_labelled(spark))
    urls = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] * 2, "page_id long, url string").withColumn("score", F.lit("clash"))
    got = {r.page_id: r for r in op1.judge(urls, weights, intercept).collect()}
    assert len(got) == len(URLS)
    buckets = {r.url: r.b for r in urls.select("url", op1.buckets(*op1.host_path(F.col("url"))).alias("b")).collect()}
    for i, u in enumerate(URLS):
        host, path, best = rule_of(u)
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, best and best[0]), u
        p = 1 / (1 + math.exp(-(intercept + sum(weights[b - 1] for b in buckets[u]))))
        assert r.score == pytest.approx(p)
        assert r.verdict == (best[1] if best else "block" if p >= 0.5 else "allow")
    assert got[12].verdict == "block" and got[13].verdict == "allow"
    assert op1.judge(urls.limit(0), weights, intercept).count() == 0


def test_url_model_separates_its_labels(spark):
    weights, intercept = op1.fit_weights(op1.default_labelled(spark))
    rows = op1.judge(op1.default_labelled(spark), weights, intercept, rules=()).collect()
    assert np.mean([(r.verdict == "block") == (r.label == 1) for r in rows]) > 0.97
    assert op1.fit_weights(op1.default_labelled(spark).where("label = 0"))[1] < 0


def repeats(ws):
    grams = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    return len({i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)})


def test_quality_rule_statistics(spark):
    docs = awkward_docs(spark).where("doc_id is null or doc_id <> 14")
    got = sorted((tuple(r) for r in op3.measure(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()), key=repr)
    want = []
    for i, t in awkward_texts():
        if i == 14:
            continue
        ws = [w.decode() for w in words(t)]
        lines = [x for x in (t or "").split("\n") if words(x)]
        rep = repeats(ws)
        want.append((i, len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), rep, len(ws) < 50 or 100 * rep > 50 * len(ws)))
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("n,k", [(10, 0), (60, 2), (1000, 1), (3000, 12), (500, 400), (1, 0)])
def test_binomial_tail_is_exact(spark, n, k):
    p = 0.0075
    row = spark.range(1).select(op3.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p).alias("p")).first()
    q = Fraction(p)
    exact = float(sum(math.comb(n, j) * q**j * (1 - q) ** (n - j) for j in range(k + 1)))
    assert row.p == pytest.approx(1.0 if k >= n * p else exact, rel=1e-9)


def test_cutoffs_limit_false_rejection(spark):
    good = [(i, "en", i % 100 / 1000) for i in range(20_000)]
    rows = spark.createDataFrame(good, "doc_id long, lang string, symbol_share double").withColumn("base_failed", F.lit(False))
    for rule in op3.GRID:
        if rule != "symbol_share":
            rows = rows.withColumn(rule, F.lit(0.0))
    lab = rows.select("doc_id", F.lit(1).alias("quality"))
    cut = op3.certify(rows, lab).first()
    kept = op3.apply_rules(rows, op3.certify(rows, lab)).where("not kept").count() / 20_000
    assert cut.cut_symbol_share == 0.1 and kept <= op3.ALPHA  # 0.07 would reject 29 %
    few = op3.certify(rows, lab.limit(20)).collect()
    assert few == []  # too few labels certify nothing
    assert op3.apply_rules(rows, op3.certify(rows, lab.limit(20))).where("kept").count() == 20_000


def test_quality_rules_on_empty_table(spark):
    m = op3.measure(empty_docs(spark))
    assert op3.apply_rules(m, op3.certify(m, labels(spark))).count() == 0


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_license_alignment_against_full_table():
    index = op4.Index(op4.TEMPLATES.items())
    grant = op4.TEMPLATES["MIT-grant"].split()
    for drop in range(0, len(grant), 7):
        text = "Some words before. " + " ".join(grant[:drop] + ["(extra)", "note"] + grant[drop + 1 :]) + " And after, other words."
        (start, end, name, share), = op4.scan_text(index, text)
        a, b = op4.folded(op4.TEMPLATES["MIT-grant"]).split(), op4.folded(text).split()
        assert name == "MIT-grant" and share == round(lcs(a, b) / len(a), 4)
        assert text[start:end].split()[0] in (grant[0], grant[1]) and text[start:end].endswith(("Software", "the"))


@pytest.mark.parametrize("between", ["", "and", "one two three", "a b c d e f g h i j k"])
def test_license_adjacent_notices(between):
    """Notices side by side are all found, repeated or of different licenses."""
    index = op4.Index(op4.TEMPLATES.items())
    for names in (["MIT"] * 2, ["MIT"] * 7, ["CC-BY-4.0"] * 3, ["Apache-2.0"] * 4, ["GPL-3.0", "GPL-2.0", "GPL-3.0"], ["CC-BY-SA-4.0", "CC-BY-4.0", "MIT", "MIT", "CC-BY-4.0"]):
        text = f" {between}\n".join(op4.TEMPLATES[n] for n in names)
        got = op4.scan_text(index, text)
        assert [n for _, _, n, _ in got] == names and all(share == 1.0 for *_, share in got)
        assert [text[a:b] for a, b, _, _ in got] == [op4.TEMPLATES[n].rstrip(".") for n in names]


def test_license_bodies_without_a_notice():
    index = op4.Index(op4.TEMPLATES.items())
    names = lambda text: [n for _, _, n, _ in op4.scan_text(index, f"Some words before.\n{text}\nOther words after.")]
    conditions = [  # as in files: other holders, quotes and list marks
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:",
        "* Redistributions of source code must retain the above copyright\n  notice, this list of conditions and the following disclaimer.",
        "* Redistributions in binary form must reproduce the above copyright\n  notice, this list of conditions and the following disclaimer in the\n"
        "  documentation and/or other materials provided with the distribution.",
    ]
    third = "* Neither the name of the University nor the names of its contributors\n  may be used to endorse or promote products derived from this software\n  without specific prior written permission."
    advertising = "* All advertising materials mentioning features or use of this software\n  must display the following acknowledgement: This product includes software developed by the University."
    disclaimer = op4._BSD_DISCLAIMER.replace("THE COPYRIGHT HOLDERS", "THE REGENTS").replace("COPYRIGHT HOLDER", "REGENTS")
    assert names("\n".join([*conditions, disclaimer])) == ["BSD-2-Clause-text"]
    assert names("\n".join([*conditions, third, disclaimer])) == ["BSD-3-Clause-text"]
    assert names("\n".join([*conditions, advertising, third, disclaimer])) == ["BSD-3-Clause"]  # four clauses: only the shared sentence
    assert names(
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, "
        "irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.") == ["Apache-2.0-text"]
    assert names("but the special requirements of the GNU Affero General Public License,\nsection 13, concerning interaction through a network will apply to the\ncombination as such.") == ["GPL-3.0-text"]


def test_license_scan_cases(spark):
    text = "Ünï é\nLICENSED under the apache license -- version 2.0! x Released under the MIT License. Licensed under CC BY-NC 4.0"
    docs = spark.createDataFrame([(1, text), (1, text), (2, None), (3, ""), (None, "Licensed under something else entirely."), (4, "word " * 50_000)], "doc_id long, text string")
    got = op4.scan(docs).collect()
    first = [r.found for r in got if r.doc_id == 1]
    assert len(got) == 6 and first[0] == first[1]
    assert [(x.license, text[x.start : x.end], x.coverage) for x in first[0]] == [
        ("Apache-2.0", "LICENSED under the apache license -- version 2.0", 1.0), ("MIT", "Released under the MIT License", 1.0), ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0", 1.0)]
    assert all(r.found == [] for r in got if r.doc_id != 1)
    assert op4.scan(awkward_docs(spark)).count() == len(awkward_texts()) and op4.scan(empty_docs(spark)).count() == 0
    assert op4.scan(docs, {}).where("size(found) > 0").count() == 0


def test_decontamination_brute_force(spark):
    norm = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    texts = awkward_texts()
    passage = texts[8][1].split()[40:70]
    bench = [(1, " ".join(passage[:12]).upper()), (2, "One"), (10, " ".join(passage[5:25])), (10, "!!"), (3, None), (4, ""), (None, "two three"), (5, "ünïcode, Ünïcode")]
    got = op6.find_contamination(awkward_docs(spark), spark.createDataFrame(bench, "item_id long, text string").withColumn("doc_id", F.lit("clash")), window=10).collect()
    want = []
    for i, t in texts:
        ws, hit, items = norm(t), set(), set()
        for item, b in bench:
            iw = norm(b)
            n = min(10, len(iw))
            for k in range(len(iw) - n + 1 if iw else 0):
                for j in range(len(ws) - n + 1):
                    if ws[j : j + n] == iw[k : k + n]:
                        hit |= set(range(j, j + n))
                        items.add(item)
        want.append((i, len(ws), len(hit), ",".join(sorted(str(x) for x in items if x is not None))))
    assert sorted(((r.doc.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=repr) == sorted(want, key=repr)
    spans = next(r.spans for r in got if r.doc.doc_id == 9)
    text = texts[8][1]
    assert text[spans[0][0] : spans[0][1]].split() == passage[:25]
    assert op6.find_contamination(empty_docs(spark), spark.createDataFrame(bench, "item_id long, text string")).count() == 0
    assert op6.find_contamination(awkward_docs(spark), spark.createDataFrame([], "item_id long, text string")).where("n_hit > 0").count() == 0
    with pytest.raises(ValueError):
        op6.find_contamination(awkward_docs(spark), spark.createDataFrame(bench, "item_id long, text string"), max_benchmark_chars=5)


SECRETS = [
    (1, 'é password: "hunter22" x'), (2, "token=abc secret: token: abcdef"), (3, "api-key=abcdefgh API_KEY = 'zz/yy+11=' apikey:abcdef"),
    (4, "AKIA" + "A" * 16 + " AKIA123 AKIAAKIA" + "B2" * 8), (5, "deadbeef" * 4 + " " + "a" * 23 + "-" + "0" * 24), (6, None), (7, ""),
    (8, "user=bob key Xy9" + "aB3" * 10 + " at https://host.example/x"), (9, "Xy9" + "aB3" * 10 + " https://host.example/x"), (10, "user=bob"),
    (11, "user=bob " + "pad " * 100 + " password=abcdef12"), (12, "login: alice " + "😀" * 5 + " passwd='s3cret!x' https://h.example/p"), (8, "user=bob key Xy9" + "aB3" * 10 + " at https://host.example/x"),
    (None, "secret = tttttt"), (13, "token = " + "q" * 50_000), (14, "SECRET=abcdef,secret=abcdef"), (15, "ſecret=abcdef toKen=abcdef"),
]


def base_spans(text):
    out = []
    for no, (pat, ok) in enumerate((
        (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
        (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    )):
        flags = re.IGNORECASE | re.ASCII if no == 0 else 0
        if no == 0:
            pat = pat.replace("[A-Za-z0-9+/_.=-]", "[A-Za-z0-9+/_.=-]")
        out += [(m.start(), no, m.end()) for m in re.finditer(pat, text or "", flags) if ok(m)]
    return ",".join(f"{op7.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_secret_scan_base_and_links(spark):
    docs = spark.createDataFrame(SECRETS, "doc_id long, text string").withColumn("spans", F.lit("clash")).withColumn("h", F.lit(1))
    rows = op7.attach(docs, op7.scan(docs)).collect()
    assert len(rows) == len(SECRETS)
    got = {}
    for r in rows:
        spans = [(s["start"], s["kind"], s["end"]) for s in r.spans or []]
        got.setdefault((r.doc.doc_id, r.doc.text), []).append(spans)
    for i, t in SECRETS:
        for spans in got[i, t]:
            assert ",".join(f"{op7.KINDS[k]}:{a}:{b}" for a, k, b in spans if k < 3) == base_spans(t), t[:60]
    weak = lambda i: sorted(op7.KINDS[k] for (d, _), s in got.items() if d == i for _, k, _ in s[0] if k >= 3)
    assert weak(8) == ["bare", "endpoint", "ident"] and weak(9) == [] and weak(10) == [] and weak(11) == []
    assert weak(12) == ["endpoint", "ident"]
    assert op7.scan(empty_docs(spark)).count() == 0


def test_secret_redaction(spark):
    docs = spark.createDataFrame([(i, t, 7) for i, t in SECRETS], "doc_id long, text string, n_chars long").withColumn("spans", F.lit("clash"))
    out = op7.redact(docs)
    assert out.columns == docs.columns and out.count() == len(SECRETS)
    by = {r.doc_id: r for r in out.collect()}
    assert by[1].text == 'é [SECRET]" x' and by[1].n_chars == len(by[1].text)
    assert by[6].text is None and by[7].text == "" and by[7].n_chars == 7 and by[9].text == dict(SECRETS)[9]
    assert by[14].text == "[SECRET],[SECRET]" and "hunter" not in by[1].text
    assert hashlib.sha256(by[10].text.encode()).digest() == hashlib.sha256(b"user=bob").digest()
