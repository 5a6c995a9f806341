"""Quality classifier: random Fourier features, ridge regression, calibration.

Statistics of a text (its characters, words, repetition and lines) are
standardised and mapped to random cosine features, which approximate a
Gaussian kernel.  Each partition sums its part of the normal equations; the
sums, of fixed size, are added up by Spark and solved once.  Scores of a
calibration fold, counted in bins, give an isotonic map to probabilities.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ocellus.llm.common import fold_of, materialise

FEATURES, WIDTH, RIDGE, BINS, SEED, KEEP = 192, 0.12, 1e-3, 400, 7, 0.3

_CLASS = np.zeros(256, np.int64)
for _i in range(256):
    _c = chr(_i)
    _CLASS[_i] = (0 if 97 <= _i <= 122 else 1 if 65 <= _i <= 90 else 2 if _c.isdigit() and _i < 128 else
                  3 if _c in " \t\r\x0b\x0c" else 4 if _c == "\n" else 5 if _c in ".,;:'\"-" else 6 if _c in "!?" else
                  7 if _c in "#$%&*" else 8 if _c in "|<>{}[]()=/\\_+@" else 9 if _i >= 128 else 10)


def statistics(text: str | None) -> list[float]:
    """A fixed number of statistics, each of moderate size; empty texts have
    zeros."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * 26
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = np.bincount(_CLASS, counts, 11) / len(raw)
    p = counts[counts > 0] / len(raw)
    n = len(words)
    kinds: dict[bytes, int] = {}
    for w in words:
        kinds[w] = kinds.get(w, 0) + 1
    sizes = np.fromiter(map(len, words), np.int64, n)
    pairs = set(zip(words, words[1:]))
    same = sum(map(bytes.__eq__, words, words[1:]))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    last = b"".join(w[-1:] for w in words)
    odd = len(last.translate(None, b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789.,"
                             + bytes(range(128, 256)))) / n
    return [
        math.log1p(n) / 4, math.log1p(len(raw)) / 5, *share.tolist(), float(-(p * np.log2(p)).sum()) / 4,
        float(sizes.mean()) / 8, float(sizes.std()) / 8, math.log1p(int(sizes.max())) / 4,
        len(kinds) / n, max(kinds.values()) / n, len(pairs) / max(1, n - 1), same / max(1, n - 1),
        len(set(lines)) / len(lines), math.log1p(len(lines)) / 4, math.log1p(n / len(lines)) / 4, odd,
        sum(map(bytes.isupper, words)) / n,
    ]


_STATS = "doc_id long, stats array<double>"


def _describe(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([statistics(t.as_py()) for t in batch.column("text")],
                                              pa.list_(pa.float64()))], names=["doc_id", "stats"])


@dataclass
class Classifier:
    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None = None
    edges: np.ndarray | None = None
    levels: np.ndarray | None = None

    def map(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        z = math.sqrt(2 / len(self.phases)) * np.cos(x @ self.waves + self.phases)
        return np.hstack([z, x / 8, np.ones((len(x), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.map(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.edges, self.levels)


def _matrix(batch) -> np.ndarray:
    lists = batch.column("stats")
    return lists.flatten().to_numpy().reshape(len(lists), -1)


def _equations(model: Classifier):
    """The partition's sums, one row per cell of the upper triangle; the last
    column of the matrix belongs to the labels."""
    def run(batches):
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            z = np.hstack([model.map(_matrix(batch)), batch.column("label").to_numpy()[:, None]])
            total = z.T @ z if total is None else total + z.T @ z
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                                             names=["i", "j", "v"])
    return run


def _raw(model: Classifier):
    def run(batches):
        for batch in batches:
            raw = model.raw(_matrix(batch)) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([pa.array(_bin(raw), pa.int32()), batch.column("label")], names=["bin", "label"])
    return run


def _bin(raw: np.ndarray) -> np.ndarray:
    return np.clip(((raw + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)


def isotonic(tally: dict[int, tuple[int, float]], prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Bin centres and never-falling levels from ``bin -> (rows, positives)``;
    pooled neighbours, one row at the prior added to each pool."""
    blocks: list[list[float]] = []
    for b in sorted(tally):
        n, pos = tally[b]
        blocks.append([pos, n, n * ((b + 0.5) / BINS * 2 - 0.5)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], last)]
    if not blocks:
        return np.array([0.0, 1.0]), np.array([prior, prior])
    at = np.array([s / n for _, n, s in blocks])
    level = np.maximum.accumulate(np.array([(pos + prior) / (n + 1) for pos, n, _ in blocks]))
    return np.r_[at[0] - 1, at, at[-1] + 1], np.r_[level[0] * 0.9, level, level[-1] + (1 - level[-1]) * 0.1]


def _score(model: Classifier | None, prior: float):
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            score = model.score(_matrix(batch)) if model and n else np.full(n, prior)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])
    return run


def fit(spark: SparkSession, stats: DataFrame, labels: DataFrame, learn: Column, calibrate: Column
        ) -> tuple[Classifier | None, float]:
    """Classifier from ``stats(doc_id, stats)`` and ``labels(doc_id, quality)``
    where ``learn`` (a condition on doc_id) holds; the part where ``calibrate``
    holds as well calibrates.  All labelled rows count.  Without two classes
    to learn from there is no classifier, only the share of label 1 (1.0
    without labels)."""
    taught = materialise(spark, stats.where(learn).join(
        labels.where("quality is not null").select("doc_id", F.col("quality").cast("double").alias("label")), "doc_id")
        .select("stats", "label", F.coalesce(calibrate, F.lit(False)).alias("check")), "quality-taught")
    n, prior = taught.agg(F.count("*"), F.avg("label")).first()
    train = taught.where("not check")
    ends = train.agg(F.min("label"), F.max("label")).first()
    if not n or ends[0] == ends[1]:
        return None, 1.0 if prior is None else prior
    size = len(statistics(None))
    moments = train.agg(*[f(F.col("stats")[i]) for i in range(size) for f in (F.avg, F.stddev_pop)]).first()
    mean, scale = np.array(moments[::2], float), np.array(moments[1::2], float)
    rng = np.random.default_rng(SEED)
    model = Classifier(mean, np.where(scale > 1e-9, scale, 1.0),
                       rng.normal(0, math.sqrt(2 * WIDTH / 2), (size, FEATURES)), rng.uniform(0, 2 * math.pi, FEATURES))
    sums = train.mapInArrow(_equations(model), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    cells = sums.toPandas()  # (FEATURES + 28)^2 / 2 rows, whatever the input
    full = np.zeros((cells["i"].max() + 1,) * 2)
    full[cells["i"], cells["j"]] = cells["v"]
    full = np.triu(full) + np.triu(full, 1).T
    gram, target = full[:-1, :-1], full[:-1, -1]
    rows = full[-2, -2]
    model.weights = np.linalg.solve(gram + RIDGE * rows * np.eye(len(gram)) / len(gram), target)
    tally = {r["bin"]: (r["n"], r["pos"]) for r in taught.where("check").mapInArrow(_raw(model), "bin int, label double")
             .groupBy("bin").agg(F.count("*").alias("n"), F.sum("label").alias("pos")).collect()}
    model.edges, model.levels = isotonic(tally, prior)
    return model, prior


def quality_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per row of ``docs``.
    Learns from labelled rows whose crc32(doc_id) mod ``folds`` is not 0
    (``held_out`` rows) and calibrates on those where it is 1.  ``predicted``
    is 1 from a score of ``KEEP`` on.  Null texts are empty ones; rows with
    null ids are scored but not learned from; labels repeated for a document
    count each; other columns of both tables are ignored."""
    stats = materialise(spark, docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                        .mapInArrow(_describe, _STATS), "quality-stats")
    fold = fold_of("doc_id", folds)
    model, prior = fit(spark, stats, labels, fold != 0, fold == 1)
    scored = stats.mapInArrow(_score(model, prior), "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= KEEP).cast("int").alias("predicted"))


def _keep(model: Classifier | None, prior: float):
    def run(batches):
        for batch in batches:
            if model and batch.num_rows:
                stats = np.array([statistics(t.as_py()) for t in batch.column("text")])
                keep = model.score(stats) >= KEEP
            else:
                keep = np.full(batch.num_rows, prior >= KEEP)
            yield batch.filter(pa.array(keep))
    return run


def good_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """The rows of ``docs`` with ``predicted`` 1, all their columns unchanged,
    learned as ``quality_scores`` does.  Null and blank texts are scored as
    empty ones, rows with null ids are scored too, repeated rows alike; an
    empty table gives none."""
    fold = fold_of("doc_id", folds)
    stats = materialise(spark, docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                        .mapInArrow(_describe, _STATS), "quality-stats")
    model, prior = fit(spark, stats, labels, fold != 0, fold == 1)
    return docs.mapInArrow(_keep(model, prior), docs.schema)
