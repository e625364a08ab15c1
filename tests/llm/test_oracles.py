"""The queries that SQL can express, against DuckDB over the same tables."""

import duckdb
import pytest

from bookmill.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, data, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    found = con.sql(ORACLES[name])
    cols = sorted(found.columns)
    df = QUERIES[name](spark, data)
    assert sorted(df.columns) == cols
    want = sorted((tuple(r[found.columns.index(c)] for c in cols) for r in found.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr) == want
