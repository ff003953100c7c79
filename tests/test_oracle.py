"""Every SQL-expressible key against DuckDB at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as E
from tools.check_oracle import compare, duck

from conftest import SF_ORACLE

KEYS = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    r = compare(spark, con, SF_ORACLE, key, E.queries()[key], E.oracle_sql()[key])
    assert r["cols"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["values"], r


def test_every_key_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_fixture_counts(spark):
    """Row counts stated for sf0.01."""
    q = E.queries()
    expect = {"coverage_overlap": 20000, "motion_vectors": 9995, "motion_vectors_irregular": 2133,
              "closest_satellite": 1981, "sliding_positions": 80984, "asof_positions": 9902,
              "history_path": 2024}
    for k, n in expect.items():
        assert q[k](spark, SF_ORACLE).count() == n, k


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "distance_km" in df.columns
