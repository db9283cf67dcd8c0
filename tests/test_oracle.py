"""Every named query against its SQL twin in DuckDB (sf0.001)."""

import pytest

from conftest import SF001
from oracle_check import compare, duck

from cordon.plans import catalog, oracle

NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF001, name, con)
    if name in oracle.oracle_sql():
        assert r["cols_match"], r
        assert r["values_match"], r
    else:
        assert r["rows"] > 0


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracle.oracle_sql())


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() == 1
    assert "did_estimate" in df.columns
