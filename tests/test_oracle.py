"""t2: every registered query against its DuckDB oracle at sf0.01."""

import pytest

from conftest import SF01
from oracle_compare import compare, duck
from salescope.plans.catalog import QUERIES
from salescope.plans.oracle import ORACLE_SQL as ORACLE


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) >= 24


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.slow
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF01), con, ORACLE[name])
    assert ok, msg
