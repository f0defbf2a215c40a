"""Half a milligram is rounded to the side of the SQL: 25 tbsp at 0.75 g/ml are 277.2525 g, which is 277.253."""

import duckdb
import pytest

import __spark_entry__ as entry
from compare import connect
from gramsmith.plans.warehouse import TYPES


@pytest.fixture(scope="module")
def tied(spark, tmp_path_factory):
    """An order k for each type k, with 25 tbsp of it and 30 g of the next type."""
    d = str(tmp_path_factory.mktemp("tied"))
    lines = [x for k in range(6) for x in ((k, 4, k, 25.0, "F"), (k, 1, (k + 1) % 6, 30.0, "F"))]
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double, l_linestatus string").write.parquet(f"{d}/lineitem.parquet")
    spark.createDataFrame([(k, t, 25) for k, t in enumerate(TYPES)], "p_partkey bigint, p_type string, p_size int").write.parquet(f"{d}/part.parquet")
    return d


def both(spark, d: str, name: str, *columns: str) -> list[tuple]:
    """The sorted rows of a query, after a check that its SQL gives the same to the last bit."""
    ours = sorted(tuple(r) for r in entry.queries()[name](spark, d).select(*columns).collect())
    duck: duckdb.DuckDBPyConnection = connect(d)
    assert ours == sorted(duck.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall())
    return ours


def wide() -> list[list[float]]:
    return [[{0: 277.253, 1: 30.0}.get((c - k) % 6, 0.0) for c in range(6)] for k in range(6)]


def test_normalize_100(spark, tied):
    rows = both(spark, tied, "normalize_100", "l_orderkey", "col_idx", "share")
    assert rows == [(k, c, pytest.approx(round(100 * g / 307.253, 6), abs=1e-9)) for k, row in enumerate(wide()) for c, g in enumerate(row)]


def test_wide_pivot(spark, tied):
    assert both(spark, tied, "wide_pivot", "l_orderkey", *[f"c{k}" for k in range(6)]) == [(k, *row) for k, row in enumerate(wide())]


def test_to_long(spark, tied):
    rows = both(spark, tied, "to_long", "l_orderkey", "col_idx", "ingredient", "value")
    assert rows == [(k, c, TYPES[c].lower(), g) for k, row in enumerate(wide()) for c, g in enumerate(row)]


def test_distinct_compositions(spark, tied):
    assert both(spark, tied, "distinct_compositions", *[f"c{k}" for k in range(6)]) == sorted(tuple(row) for row in wide())


def test_merge_full(spark, tied):
    rows = both(spark, tied, "merge_full", "l_orderkey", "c0", "c1", "c2", "c3")
    assert rows == [(k, round(r[0] + r[5], 6), round(r[1] + r[2], 6), r[3], r[4]) for k, r in enumerate(wide())]


def test_merge_partial(spark, tied):
    rows = both(spark, tied, "merge_partial", "l_orderkey", "c0", "c1", "c2", "c3")
    assert rows == [(k, pytest.approx(r[1] + r[0] * 0.25, abs=1e-6), pytest.approx(r[2] * 0.5 + r[5], abs=1e-6), r[3], r[4]) for k, r in enumerate(wide())]
