"""Every query with SQL gives the rows that DuckDB gives."""

import duckdb
import numpy as np
import pytest

from leadloom.plans import catalog, lifecycle, pages, tables  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, (list, tuple, np.ndarray)):
        return str([plain(x) for x in v])
    return f"{v:.9g}" if isinstance(v, float) else "" if v is None else str(v)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rel = duck.sql(catalog.ORACLES[name])
    assert sorted(rel.columns) == cols
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    want = sorted(tuple(plain(dict(zip(rel.columns, r))[c]) for c in cols) for r in rel.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_other_queries_run(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0
