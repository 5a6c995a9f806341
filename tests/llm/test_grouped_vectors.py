"""Recall of the graph search on vectors that lie in groups."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ocellus.llm import ann


def grouped(n, size, spread, seed, third=False):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // size, 64))
    x = centres[rng.integers(0, len(centres), n)] + spread * rng.normal(size=(n, 64))
    if third:
        x[:n // 3] = rng.normal(size=64) + spread * rng.normal(size=(n // 3, 64))
    return x.astype(np.float32)


@pytest.mark.parametrize("size,spread,third", [(80, 0.05, False), (60, 0.01, False), (20, 0.01, False), (60, 0.05, True)])
def test_recall_on_groups(size, spread, third):
    hits = queries = 0
    for seed in range(2):
        x = grouped(8192, size, spread, seed, third)
        q = np.random.default_rng(seed + 50).choice(len(x), 120, replace=False)
        found = ann.search(x, ann.build(x, seed), x[q], 11)
        for i, row in zip(q, found):
            want = np.argsort(((x - x[i]) ** 2).sum(1), kind="stable")[:11]
            near = len(set(want) & set(row)) - 1
            hits, queries = hits + max(0, near), queries + 1
    assert hits >= 0.95 * 10 * queries


def test_recall_on_several_shards(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 1500)
    x = grouped(6000, 400, 0.01, 3)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in ann.nearest(spark, df, F.expr("vec_id % 50 = 0"), 10).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in range(0, 6000, 50):
        d = ((x.astype(float) - x[q].astype(float)) ** 2).sum(1)
        hits += len(got[q] & {int(i) for i in np.argsort(d, kind="stable") if i != q} & set(
            [int(i) for i in np.argsort(d, kind="stable") if i != q][:10]))
    assert hits >= 0.95 * 10 * 120


def test_recall_far_from_the_origin(spark, monkeypatch):
    """An offset that single precision could not tell apart, several shards,
    and vectors of two lengths, each among its own."""
    monkeypatch.setattr(ann, "SHARD_ROWS", 1500)
    rng = np.random.default_rng(9)
    x = 100 + 0.01 * rng.normal(size=(4000, 64))
    y = 1e6 + 1e-3 * rng.normal(size=(300, 5))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(10_000 + i, v.tolist()) for i, v in enumerate(y)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(spark, df, F.expr("vec_id % 50 = 0"), 10).collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    for first, v in ((0, x), (10_000, y)):
        hits = queries = 0
        for q in range(0, len(v), 50):
            d = np.sqrt(((v - v[q]) ** 2).sum(1))
            found = got[first + q]
            assert len(found) == 10 and all(abs(s - d[i - first]) <= 1e-12 for i, s in found)
            hits += len({i - first for i, _ in found} & {i for i in np.argsort(d, kind="stable")[:11] if i != q})
            queries += 1
        assert hits >= 0.95 * 10 * queries


def test_recall_in_many_dimensions():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 768))[rng.integers(0, 40, 1500)] + 0.3 * rng.normal(size=(1500, 768))
    x = (x - x.mean(0)).astype(np.float32)
    found = ann.search(x, ann.build(x), x[:100], 11)
    hits = sum(len(set(np.argsort(((x - x[i]) ** 2).sum(1))[:11]) & set(row)) - 1 for i, row in enumerate(found))
    assert hits >= 0.95 * 1000
