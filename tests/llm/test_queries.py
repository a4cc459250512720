"""Every registered query that has SQL against it, on whole tables."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck
from salescope.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    ok, message = compare(QUERIES[name](spark, SF), duck(SF), ORACLE_SQL[name])
    assert ok, message
