"""The mixing stage's jobs: few, whatever is searched, and alike for few and
many cells."""

import warnings

import pytest

from ocellus.llm import mixing


def _docs(spark):
    """Uneven cells whose tempered targets allow less than the budget."""
    rows = [(f"{s}-{g}-{i}", "w " * n, s, g)
            for s, k in (("a", 60), ("b", 12), ("c", 2)) for g, m in (("en", 1.0), ("de", 0.3), (None, 0.1))
            for i, n in enumerate([30, 150, 700][: 1 + k % 7] * max(1, int(k * m / 3)))]
    return spark.createDataFrame(rows, "doc_id string, text string, source string, lang string").repartition(24)


def _cells(spark, docs):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return sorted(mixing.mixing_cells(spark, docs, targets_first=True).collect(), key=str)


def test_a_round_is_two_stages(spark, monkeypatch):
    """A round's cells and error take a stage each; with joins and shuffles
    there were over 200 stages here."""
    tried, inner, status = [], mixing._bounded, spark.sparkContext.statusTracker()
    monkeypatch.setattr(mixing, "_bounded", lambda *a, **k: tried.append(a[2]) or inner(*a, **k))
    spark.sparkContext.setJobGroup("mixing-jobs", "mixing")
    try:
        docs = _docs(spark)
        assert len(_cells(spark, docs)) > 9
        jobs = [status.getJobInfo(j) for j in status.getJobIdsForGroup("mixing-jobs")]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.sparkContext.setLocalProperty("spark.job.description", None)
    assert tried
    assert sum(len(j.stageIds) for j in jobs) < 100


def test_few_and_many_cells_give_the_same(spark, monkeypatch):
    docs = _docs(spark)
    few = _cells(spark, docs)
    monkeypatch.setattr(mixing, "FEW_CELLS", 0)
    many = _cells(spark, docs)
    assert [c[:4] for c in few] == [c[:4] for c in many]
    for a, b in zip(few, many):
        assert a["probability"] == pytest.approx(b["probability"], rel=1e-9)
        assert a["weight"] == pytest.approx(b["weight"], rel=1e-9)
        assert a["budget"] == pytest.approx(b["budget"], rel=1e-9)


def test_a_target_of_no_share(spark):
    """A value that is asked for nothing gets nothing, and the others all."""
    targets = {"source": spark.createDataFrame([("=a", 0.7), ("=b", 0.3), ("=c", 0.0)], "value string, share double")}
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        cells = mixing.mixing_cells(spark, _docs(spark), targets=targets, targets_first=True).collect()
    assert {c["probability"] for c in cells if c["_source"] == "=c"} == {0.0}
    kept = {s: sum(c["t"] * c["probability"] for c in cells if c["_source"] == f"={s}") for s in "ab"}
    assert kept["a"] / sum(kept.values()) == pytest.approx(0.7, abs=0.005)
