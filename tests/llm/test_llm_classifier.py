"""op10 against a direct fit: statistics by plain Python, weights by least squares over the
whole table at once, the isotonic curve by its min-max formula."""

import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from llm_cases import awkward_texts

from txmart.llm import op10_quality_classifier as op10

SF = "/root/testdata/sf0.01"


def fold_of(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5


def direct_weights(stats, y):
    """Ridge as least squares with one more row per penalised weight; no normal equations."""
    mean, spread = stats.mean(axis=0), stats.std(axis=0)
    scale = np.where(spread > 1e-9, spread, 1.0)
    rng = np.random.default_rng(11)
    freq = rng.normal(scale=1 / np.sqrt(op10.N_STATS), size=(op10.N_STATS, op10.FEATURES))
    phase = rng.uniform(0, 2 * np.pi, op10.FEATURES)

    def features(s):
        cosines = [np.sqrt(2 / op10.FEATURES) * np.cos(np.clip((row - mean) / scale, -8, 8) @ freq + phase) for row in s]
        return np.column_stack([np.array(cosines), np.ones(len(s))])

    penalty = np.diag([np.sqrt(1e-3 * len(y))] * op10.FEATURES + [np.sqrt(1e-9)])
    weight = np.linalg.lstsq(np.vstack([features(stats), penalty]), np.concatenate([y, np.zeros(op10.FEATURES + 1)]), rcond=None)[0]
    return features, weight


def min_max_curve(ones, n):
    """Isotonic regression value of each bin: the greatest over starts of the least average over ends."""
    total = lambda a, b: Fraction(int(sum(ones[a : b + 1])), int(sum(n[a : b + 1])))
    k = len(n)
    least = {(a, i): min(total(a, b) for b in range(i, k)) for a in range(k) for i in range(a, k)}
    return [max(least[a, i] for a in range(i + 1)) for i in range(k)]


def curve_of(at, ones, n):
    level = min_max_curve(ones, n)
    x, y = [], []
    for v in sorted(set(level)):
        mine = [i for i, u in enumerate(level) if u == v]
        x.append(sum(at[i] * n[i] for i in mine) / sum(n[i] for i in mine))
        y.append((sum(ones[i] for i in mine) + 0.5) / (sum(n[i] for i in mine) + 1.0))
    return np.array(x), np.maximum.accumulate(y)


def test_scores_equal_a_direct_fit(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    known = {r["doc_id"]: r["quality"] for r in labels.select("doc_id", "quality").where("quality is not null").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = sorted(texts)
    stats = np.array([op10.text_statistics(texts[i]) for i in ids])
    pick = lambda folds: np.array([k for k, i in enumerate(ids) if i in known and fold_of(i) in folds])
    fit, cal = pick({1, 2, 3}), pick({4})
    y = lambda rows: np.array([float(known[ids[k]]) for k in rows])
    features, weight = direct_weights(stats[fit], y(fit))
    raw = features(stats) @ weight
    bins = ((np.clip(raw[cal], -1, 2) + 1) / 3 * (op10.BINS - 1)).astype(int)
    at = sorted(set(bins.tolist()))
    ones, n = [int(y(cal)[bins == b].sum()) for b in at], [int((bins == b).sum()) for b in at]
    assert len(fit) > op10.N_STATS and 0 < sum(ones) < sum(n)
    x, rate = curve_of([b / (op10.BINS - 1) * 3 - 1 for b in at], ones, n)
    expected = np.interp(raw, x, rate)
    got = {r["doc_id"]: r for r in op10.op10_quality_classifier(spark, SF).collect()}
    assert sorted(got) == ids
    assert np.allclose([got[i]["score"] for i in ids], expected, atol=1e-6)
    assert [got[i]["held_out"] for i in ids] == [fold_of(i) == 0 for i in ids]
    clear = [k for k in range(len(ids)) if abs(expected[k] - 0.3) > 1e-6]
    assert [got[ids[k]]["predicted"] for k in clear] == [int(expected[k] >= 0.3) for k in clear] and len(clear) > 0.99 * len(ids)


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    stats = op10.text_stats(docs)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    turned = labels.selectExpr("doc_id", f"case when crc32(cast(cast(doc_id as string) as binary)) % {op10.FOLDS} = 0 then 1 - quality else quality end as quality")
    assert turned.exceptAll(labels).count() > 0
    one, other = op10.train(stats, labels), op10.train(stats, turned)
    assert np.array_equal(one.weight, other.weight) and np.array_equal(one.curve_y, other.curve_y)


@pytest.mark.parametrize("seed", range(6))
def test_pooled_curve_equals_the_min_max_formula(seed):
    rng = np.random.default_rng(seed)
    n = rng.integers(1, 6, 25)
    ones = np.array([rng.integers(0, k + 1) for k in n])
    at = np.sort(rng.uniform(-1, 2, 25))
    x, y = op10.isotonic(at, ones.astype(float), n.astype(float))
    expect_x, expect_y = curve_of(at.tolist(), ones.tolist(), n.tolist())
    assert np.allclose(np.interp(at, x, y), np.interp(at, expect_x, expect_y)) and np.allclose(y, expect_y)


def plain_statistics(text):
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return [0.0] * op10.N_STATS
    kinds = Counter()
    for b in data:
        c = chr(b)
        kinds["lower" if "a" <= c <= "z" else "upper" if "A" <= c <= "Z" else "digit" if "0" <= c <= "9" else "line" if c == "\n" else
              "blank" if c in " \t\x0b\x0c\r" else "stop" if c in ".,;:?'\"" else "symbol" if c in "#*$%&|<>" else "bang" if c == "!" else "far" if b > 127 else "other"] += 1
    size, words = len(data), data.split()
    share = lambda name: (kinds[name] / size) ** 0.5
    out = [np.log1p(size), np.log1p(len(words)), *[share(k) for k in ("other", "lower", "upper", "digit", "blank", "line", "stop", "symbol", "bang", "far")]]
    out.append(-sum(c / size * np.log(c / size) for c in Counter(data).values()))
    letters = kinds["lower"] + kinds["upper"]
    out.append(kinds["upper"] / letters if letters else 0)
    if words:
        runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        out += [np.log1p((size - kinds["blank"] - kinds["line"]) / len(words)), len(set(words)) / len(words), max(Counter(words).values()) / len(words),
                1 - len(set(runs)) / len(runs) if runs else 0]
        out += [min(4.0, kinds[k] / len(words)) ** 0.5 for k in ("symbol", "bang", "stop")]
    else:
        out += [0.0] * 7
    lines = [x for x in data.split(b"\n") if x.strip()]
    return out + ([1 - len(set(lines)) / len(lines), np.log1p(size / len(lines)), np.log1p(len(lines))] if lines else [0.0] * 3)


def test_statistics_equal_plain_counts():
    texts = [t for _, t in awkward_texts()] + ["a!b? #1\r\nA\x0bB\n\n a!b?", "\n", "é", "x " * 50_000, "q" * 100_000]
    for text in texts:
        assert np.allclose(op10.text_statistics(text), plain_statistics(text)), (text or "")[:40]
