"""The SQL of the training-data queries against the queries, and against plain versions."""

import os

import brute
import duckdb
import pytest

from framewright.llm import queries


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    return c


def rows(data, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in data), key=repr), [columns[i] for i in order]


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_against_sql(spark, duck, sf, name):
    df = queries.QUERIES[name](spark, sf)
    want = duck.sql(queries.ORACLE_SQL[name])
    assert not [t for t in want.types if "DECIMAL" in str(t) or "HUGE" in str(t)]
    assert rows([tuple(r) for r in df.collect()], df.columns) == rows(want.fetchall(), want.columns)


def test_sql_against_plain_versions(duck):
    docs = duck.sql("select doc_id, text from documents").fetchall()
    assert sorted(duck.sql(queries.OP2_SQL).fetchall()) == sorted((d, n, c) for d, n, c in brute.jaccard_groups(docs, 4, 85))
    assert sorted(duck.sql(queries.OP3_SQL).fetchall()) == sorted(brute.repeats(docs, 50))
