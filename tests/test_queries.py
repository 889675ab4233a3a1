"""Every query of the engine against its SQL in DuckDB."""

import os

import duckdb
import pytest

from framewright import queries as q


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    c.execute("set TimeZone='UTC'")
    for f in os.listdir(sf):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    return c


def rows(data, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in data), key=repr), [columns[i] for i in order]


@pytest.mark.parametrize("name", list(q.QUERIES))
def test_query(spark, duck, sf, name):
    df = q.QUERIES[name](spark, sf)
    got, columns = rows([tuple(r) for r in df.collect()], df.columns)
    if name in q.ORACLE_SQL:
        r = duck.sql(q.ORACLE_SQL[name])
        assert not [t for t in r.types if "DECIMAL" in str(t)], r.types
        want, names = rows(r.fetchall(), r.columns)
        assert columns == names
        assert got == want
    else:
        assert got


def test_entry_keeps_names_together():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(q.QUERIES) <= set(e.queries())
