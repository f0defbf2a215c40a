"""Lines whose number has no unit have no weight, and amounts are rounded as the SQL does: 2.5 g are 2 g, 2.7 g are 3 g."""

import pytest

from gramsmith.plans.warehouse import TYPES
from tests.test_ties import both

# line number, amount and grams of the odd line of an order
ODD = {
    "outside": [(8, 5.0, 0.0), (0, 5.0, 0.0), (-8, 5.0, 0.0)] * 2,
    "null": [(None, 5.0, 0.0)] * 6,
    "fractions": [(1, 2.5, 2.0), (1, 3.5, 4.0), (1, 2.7, 3.0), (1, 0.4, 0.0), (1, 0.5, 0.0), (1, 1.5, 2.0)],
}


@pytest.fixture(scope="module", params=ODD)
def odd(spark, tmp_path_factory, request):
    """An order k for each type k, with 30 g of it and an odd line of the next type; the folder and the wide rows."""
    d, rows = str(tmp_path_factory.mktemp("odd")), ODD[request.param]
    lines = [x for k, (n, amount, _) in enumerate(rows) for x in ((k, 1, k, 30.0, "F"), (k, n, (k + 1) % 6, amount, "F"))]
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double, l_linestatus string").write.parquet(f"{d}/lineitem.parquet")
    spark.createDataFrame([(k, t, 25) for k, t in enumerate(TYPES)], "p_partkey bigint, p_type string, p_size int").write.parquet(f"{d}/part.parquet")
    return d, [[{0: 30.0, 1: grams}.get((c - k) % 6, 0.0) for c in range(6)] for k, (_, _, grams) in enumerate(rows)]


def test_wide_pivot(spark, odd):
    d, wide = odd
    assert both(spark, d, "wide_pivot", "l_orderkey", *[f"c{k}" for k in range(6)]) == [(k, *r) for k, r in enumerate(wide)]


def test_to_long(spark, odd):
    d, wide = odd
    rows = both(spark, d, "to_long", "l_orderkey", "col_idx", "ingredient", "value")
    assert rows == [(k, c, TYPES[c].lower(), g) for k, r in enumerate(wide) for c, g in enumerate(r)]


def test_distinct_compositions(spark, odd):
    d, wide = odd
    assert both(spark, d, "distinct_compositions", *[f"c{k}" for k in range(6)]) == sorted(tuple(r) for r in wide)


def test_merge_full(spark, odd):
    d, wide = odd
    assert both(spark, d, "merge_full", "l_orderkey", "c0", "c1", "c2", "c3") == [(k, r[0] + r[5], r[1] + r[2], r[3], r[4]) for k, r in enumerate(wide)]


def test_merge_partial(spark, odd):
    d, wide = odd
    assert both(spark, d, "merge_partial", "l_orderkey", "c0", "c1", "c2", "c3") == [(k, r[1] + r[0] * 0.25, r[2] * 0.5 + r[5], r[3], r[4]) for k, r in enumerate(wide)]
