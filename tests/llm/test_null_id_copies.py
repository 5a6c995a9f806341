"""Copies with a null id that come before their near-duplicate group."""

import random

from ocellus.llm import ngram_join

from test_llm import changed, words


def test_null_id_copy_first(spark):
    rng = random.Random(8)
    rows, want = [], {}
    for i in range(6):
        base = words(rng, 150)
        rows += [(None, base), (10 * i, base), (10 * i + 1, changed(rng, base, 1))]
        want.update({10 * i: 10 * i, 10 * i + 1: 10 * i})
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = ngram_join.ngram_components(spark, docs, 5, 4, 5).collect()
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == want
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None] * 6
