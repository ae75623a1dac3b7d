"""Every query with SQL against DuckDB, as the driver does, at the smallest scale."""

import math

import duckdb
import pytest

from readloom.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql("set timezone='UTC'")
    for name in TABLES:
        c.sql(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return c


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return v if v is None or isinstance(v, (int, bool)) else str(v)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    got = sorted(repr(sorted((k, norm(v)) for k, v in r.asDict().items())) for r in df.collect())
    if name not in registry.ORACLE:
        assert df.columns
        return
    rel = con.sql(registry.ORACLE[name])
    want = sorted(repr(sorted((k, norm(v)) for k, v in zip(rel.columns, r))) for r in rel.fetchall())
    assert got == want
