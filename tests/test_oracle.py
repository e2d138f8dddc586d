"""The driver's correctness gate, in the test suite: every registered query
against its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from scripts.oracle_check import compare, duck
from tests.conftest import SF_SMALL

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, E.queries()[name], ORACLES[name], SF_SMALL)
    assert ok, f"{name}: {msg}"
