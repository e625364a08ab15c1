"""Every query of the library against the SQL that stands beside it, in DuckDB over the same tables."""

import duckdb
import pytest

from bookmill.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 5) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_oracle(spark, duck, data, name):
    df = catalog.QUERIES[name](spark, data)
    cols = sorted(df.columns)
    own = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    found = duck.sql(catalog.ORACLES[name])
    names = list(found.columns)
    assert sorted(names) == cols
    other = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in found.fetchall()), key=repr)
    assert own == other


def test_flagship(spark, data):
    assert catalog.flagship(spark, data).count() > 0
