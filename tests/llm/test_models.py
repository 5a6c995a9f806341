"""Trained models against plain computations: Kneser-Ney character models,
and the ridge and isotonic fits of the quality classifier."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ocellus.llm import language, quality


def plain_kneser_ney(grams):
    """P(c | a, b) from a list of trigrams, straight from the definition."""
    three = Counter(grams)
    two = Counter(g[1:] for g in three)
    one = Counter(g[1:] for g in two)

    def discount(counts):
        ones, twos = (sum(1 for n in counts.values() if n == k) for k in (1, 2))
        return ones / (ones + 2 * twos) if ones and twos else 0.5

    def level(counts, lower):
        d, total, kinds = discount(counts), defaultdict(int), defaultdict(int)
        for g, n in counts.items():
            total[g[:-1]] += n
            kinds[g[:-1]] += 1

        def p(g):
            rest = lower(g[1:])
            if g[:-1] not in total:
                return rest
            return max(counts[g] - d, 0) / total[g[:-1]] + min(1, d * kinds[g[:-1]] / total[g[:-1]]) * rest
        return p

    return level(three, level(two, level(one, lambda g: 1 / 128)))


def test_kneser_ney_equals_the_definition():
    rng = random.Random(6)
    codes = [rng.choices(range(1, 12), k=3) for _ in range(900)]
    packed = np.array([a << 14 | b << 7 | c for a, b, c in codes])
    code, n = np.unique(packed, return_counts=True)
    model, plain = language.kneser_ney(code, n), plain_kneser_ney([tuple(c) for c in codes])
    for a in range(0, 14, 3):
        for b in range(0, 14, 2):
            got = model.probability((a << 14 | b << 7) + np.arange(14))
            assert np.allclose(got, [plain((a, b, c)) for c in range(14)], rtol=1e-12)


def corpus(n=300):
    rng = random.Random(3)
    syl = {"xx": ["ka", "lo", "mi", "tun"], "yy": ["sch", "ei", "ung", "ver"], "zz": ["qua", "zio", "lo", "ne"], "ww": ["ko", "lu"]}
    rows = []
    for i in range(n):
        lang = sorted(syl)[i % 4]
        rows.append((i, " ".join("".join(rng.choices(syl[lang], k=3)) for _ in range(rng.randrange(1, 9))), lang))
    return rows + [(900, None, "xx"), (901, "12", None), (None, "kalomi", "yy"), rows[5], rows[5]]


def test_lowest_cross_entropy_wins(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.identify(spark, df, F.col("doc_id") < 200, F.col("doc_id") % 4 == 3).collect()
    assert len(got) == len(rows)
    plain = {}
    for lang in ("ww", "xx", "yy", "zz"):
        grams = [tuple(int(c >> s & 127) for s in (14, 7, 0)) for i, t, own in rows
                 if own == lang and t and i is not None and i < 200 for c in language.trigrams(t)]
        plain[lang] = plain_kneser_ney(grams)
    for r in got[:60]:
        text = next(t for i, t, _ in rows if i == r["doc_id"])
        codes = language.trigrams(text or "")
        bits = {g: sum(-math.log2(p(tuple(int(c >> s & 127) for s in (14, 7, 0)))) for c in codes) / max(1, len(codes))
                for g, p in plain.items()}
        if len(codes):
            assert r["lang_pred"] == min(bits, key=lambda g: (round(bits[g], 9), g))
            assert abs(r["bits"] - min(bits.values())) < 1e-9


@pytest.mark.parametrize("held", [50, 2_000_000])
def test_blocks_of_languages_give_the_same_answers(spark, monkeypatch, held):
    df = spark.createDataFrame(corpus(), "doc_id long, text string, lang string")
    want = language.held_out_identification(spark, df).collect()
    monkeypatch.setattr(language, "MOST_GRAMS", 60)
    monkeypatch.setattr(language, "HELD", held)
    got = language.held_out_identification(spark, df).collect()

    def rounded(rows):
        return sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in rows)

    assert rounded(got) == rounded(want)


def test_ridge_and_calibration_equal_a_dense_solve(spark):
    rng = np.random.default_rng(8)
    texts = [" ".join(rng.choice(["alpha", "beta!", "##", "Gamma", "x1", "the"], rng.integers(1, 60))) for _ in range(300)]
    marks = [(i, int(t.count("#") < len(t) / 9)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    stats = df.mapInArrow(quality._describe, quality._STATS)
    model, prior = quality.fit(spark, stats, labels, F.col("doc_id") % 5 != 0, F.col("doc_id") % 5 == 1)

    table = np.array([quality.statistics(t) for t in texts])
    y = np.array([m for _, m in marks], float)
    train = np.array([i % 5 not in (0, 1) for i in range(300)])
    assert np.allclose(model.mean, table[train].mean(0))
    z = model.map(table)
    gram = z[train].T @ z[train] + quality.RIDGE * train.sum() * np.eye(z.shape[1]) / z.shape[1]
    assert np.allclose(z @ model.weights, z @ np.linalg.solve(gram, z[train].T @ y[train]), atol=1e-6)

    check = np.array([i % 5 == 1 for i in range(300)])
    bins = quality._bin(z[check] @ model.weights)
    tally = {int(b): (int((bins == b).sum()), float(y[check][bins == b].sum())) for b in np.unique(bins)}
    edges, levels = quality.isotonic(tally, prior)
    assert np.allclose(edges, model.edges) and np.allclose(levels, model.levels)
    assert abs(prior - y[train | check].mean()) < 1e-12


def pooled(tally):
    """Isotonic means by the min-max formula."""
    bins = sorted(tally)
    n, pos = np.array([tally[b][0] for b in bins], float), np.array([tally[b][1] for b in bins], float)
    return [max(min(pos[a:b + 1].sum() / n[a:b + 1].sum() for b in range(i, len(bins))) for a in range(i + 1)) for i in range(len(bins))]


def test_isotonic_equals_the_min_max_formula():
    rng = np.random.default_rng(5)
    for _ in range(20):
        tally = {int(b): (int(k := rng.integers(1, 30)), float(rng.integers(0, k + 1))) for b in rng.choice(400, 25, replace=False)}
        edges, levels = quality.isotonic(tally, 0.5)
        want = pooled(tally)
        blocks = []  # bins of equal mean, shrunk towards the prior by one row
        for b, m in zip(sorted(tally), want):
            if blocks and abs(blocks[-1][0] - m) < 1e-12:
                blocks[-1][1].append(b)
            else:
                blocks.append([m, [b]])
        sums = [(sum(tally[b][1] for b in g), sum(tally[b][0] for b in g)) for _, g in blocks]
        assert np.allclose(levels[1:-1], np.maximum.accumulate([(p + 0.5) / (n + 1) for p, n in sums]))
