"""Every query with SQL gives the rows that DuckDB does, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from compare import connect, norm


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_equals_sql(spark, data, duck: duckdb.DuckDBPyConnection, name):
    df = entry.queries()[name](spark, data)
    cur = duck.execute(entry.oracle_sql()[name])
    cols = [x[0] for x in cur.description]
    order = sorted(cols)
    assert sorted(df.columns) == order
    ours = sorted(tuple(norm(r[k]) for k in order) for r in df.collect())
    theirs = sorted(tuple(norm(r[cols.index(k)]) for k in order) for r in cur.fetchall())
    assert ours == theirs


def test_sql_only_for_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark, data):
    assert entry.entry(spark).count() == 6
