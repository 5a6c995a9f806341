"""Every registered query with an oracle equals its DuckDB twin (sf0.001)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

KEYS = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_matches_duckdb(spark, con, key):
    r = compare(spark, con, key, entry.queries()[key], entry.oracle_sql()[key], SF_SMALL)
    assert r["status"] == "ok", r


def test_every_query_has_a_callable_and_entry_runs(spark):
    qs = entry.queries()
    assert set(entry.oracle_sql()) <= set(qs)
    df = entry.entry(spark)
    assert df.columns == ["label", "n", "n_correct", "accuracy"]
    assert df.count() > 0
