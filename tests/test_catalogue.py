"""Every catalogue query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

from hushwire.plans.catalogue import ORACLE_SQL, QUERIES, TABLES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    if isinstance(v, bool | str):
        return str(v)
    return f"{float(v):.5f}"


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    got = df.collect()
    if name in ORACLE_SQL:
        want = duck.execute(ORACLE_SQL[name])
        columns = [d[0] for d in want.description]
        assert sorted(columns) == sorted(df.columns)
        assert rows(df.columns, got) == rows(columns, want.fetchall())
