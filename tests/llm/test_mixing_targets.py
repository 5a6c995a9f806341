"""The sample's expected tokens have the target shares."""

import pytest
from pyspark.sql import functions as F

from ocellus.llm import mixing
from ocellus.session import read_table


@pytest.mark.parametrize("hot", [False, True])
def test_expected_shares_meet_the_targets(spark, hot, recwarn):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    if hot:
        docs = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source")))
    rows = mixing.mixed(spark, docs).select("_source", "_lang", "_topic", "_tokens", "_probability").collect()
    assert all(0 < r["_probability"] <= 1 for r in rows)
    total = sum(r["_tokens"] for r in rows)
    sample = sum(r["_tokens"] * r["_probability"] for r in rows)
    for d, power in enumerate((0.7, 0.7, 0.9)):
        have, got = {}, {}
        for r in rows:
            have[r[d]] = have.get(r[d], 0) + r["_tokens"]
            got[r[d]] = got.get(r[d], 0) + r["_tokens"] * r["_probability"]
        tempered = {v: n ** power for v, n in have.items()}
        for v in have:
            want = tempered[v] / sum(tempered.values())
            assert abs(got[v] / sample - want) < 0.005 * want
    assert 0.5 * total < sample < mixing.BUDGET * total
    assert any("the targets allow" in str(w.message) for w in recwarn)


def test_a_budget_that_the_targets_allow_is_met(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    cells = mixing.mixing_cells(spark, docs, budget=0.3, targets_first=True).collect()
    assert abs(sum(c["t"] * c["probability"] for c in cells) / sum(c["t"] for c in cells) - 0.3) < 1e-3
    assert {c["budget"] for c in cells} == {0.3}
