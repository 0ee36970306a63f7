"""Every registered query against its SQL on DuckDB."""

import functools
import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from lernspur.plans import queries

SQL = entry.oracle_sql()
OWN = sorted(queries.QUERIES)


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for path in glob.glob(f"{data}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


@pytest.fixture(scope="module", autouse=True)
def shared_graphs():
    """Queries on graphs share them here; by themselves each builds its own."""
    build = queries._graphs
    queries._graphs = functools.cache(build)
    yield
    queries._graphs = build


def _rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    text = [tuple("null" if r[i] is None else repr(r[i]) for i in order) for r in values]
    return [names[i] for i in order], sorted(text)


def test_every_query_has_sql():
    assert set(OWN) <= set(entry.queries()) and set(OWN) <= set(SQL)
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", OWN)
def test_query(spark, data, duck, name):
    df = entry.queries()[name](spark, data)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(SQL[name])
    names = [c[0] for c in result.description]
    assert got == _rows(names, result.fetchall())
