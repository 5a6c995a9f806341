"""Driver contract: stable schemas, and column names equal to the oracle's."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_schema_stable_and_named_like_oracle(spark, key):
    import duckdb
    q = entry.queries()[key]
    a, b = q(spark, SF_SMALL).schema, q(spark, SF_SMALL).schema
    assert a == b
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages "
              "benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    cur = con.execute(f"SELECT * FROM ({entry.oracle_sql()[key]}) LIMIT 0")
    assert sorted(f.name for f in a.fields) == sorted(d[0] for d in cur.description)
