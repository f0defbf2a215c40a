"""Sums of more milligrams than a bigint holds are those of the SQL, and large merges are rounded as it does."""

from math import floor

import pytest

import __spark_entry__ as entry
from gramsmith.plans.warehouse import TYPES
from tests.test_ties import both

CUPS = floor(2e9 * (238.337210755 * (0.5 + 1_500_000 / 100)) * 1000 + 0.5)  # milligrams of a line


def stored(spark, d: str, lines: list[tuple], size: int) -> str:
    """Tables of lines (order, line number, part, amount) and a part of a size for each type."""
    spark.createDataFrame([(*x, "F") for x in lines], "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double, l_linestatus string").write.parquet(f"{d}/lineitem.parquet")
    spark.createDataFrame([(k, t, size) for k, t in enumerate(TYPES)], "p_partkey bigint, p_type string, p_size int").write.parquet(f"{d}/part.parquet")
    return d


@pytest.fixture(scope="module")
def large(spark, tmp_path_factory):
    """An order k for each type k, with 20 lines of it that together exceed a bigint, and 30 g of the next type."""
    assert CUPS < 2**63 < 20 * CUPS
    lines = [x for k in range(6) for x in [(k, 3, k, 2e9)] * 20 + [(k, 1, (k + 1) % 6, 30.0)]]
    return stored(spark, str(tmp_path_factory.mktemp("large")), lines, 1_500_000)


def wide() -> list[list[float]]:
    return [[{0: 20 * CUPS / 1000, 1: 30.0}.get((c - k) % 6, 0.0) for c in range(6)] for k in range(6)]


def test_to_long(spark, large):
    rows = both(spark, large, "to_long", "l_orderkey", "col_idx", "ingredient", "value")
    assert rows == [(k, c, TYPES[c].lower(), g) for k, row in enumerate(wide()) for c, g in enumerate(row)]


def test_line_beyond_bigint_fails(spark, tmp_path):
    """As its SQL does: such a line isn't the largest bigint."""
    d = stored(spark, str(tmp_path), [(0, 3, 0, 2e9)], 2_000_000_000)
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        entry.queries()["to_long"](spark, d).collect()


def test_distinct_compositions(spark, large):
    assert both(spark, large, "distinct_compositions", *[f"c{k}" for k in range(6)]) == sorted(tuple(row) for row in wide())


ROUNDED = 414706743810.7529  # what 414706743810.753 g are when rounded by a product with 10^6


@pytest.fixture(scope="module")
def rounded(spark, tmp_path_factory):
    """An order k for each type k, with 414706743810.753 g of it."""
    return stored(spark, str(tmp_path_factory.mktemp("rounded")), [(k, 3, k, 1999999986.0) for k in range(6)], 37)


def test_merge_full(spark, rounded, large):
    rows = both(spark, rounded, "merge_full", "l_orderkey", "c0", "c1", "c2", "c3")
    assert rows == [(k, *[ROUNDED if k in types else 0.0 for types in ((0, 5), (1, 2), (3,), (4,))]) for k in range(6)]
    assert len(both(spark, large, "merge_full", "l_orderkey", "c0", "c1", "c2", "c3")) == 6


def test_merge_partial(spark, rounded, large):
    rows = both(spark, rounded, "merge_partial", "l_orderkey", "c0", "c1", "c2", "c3")
    assert [r for r in rows if r[0] not in (0, 2)] == [(k, *[ROUNDED if k == t else 0.0 for t in (1, 5, 3, 4)]) for k in (1, 3, 4, 5)]
    assert len(both(spark, large, "merge_partial", "l_orderkey", "c0", "c1", "c2", "c3")) == 6
