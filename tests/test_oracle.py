"""Every registered query that has an oracle equals it."""

import pytest

import __spark_entry__ as entry_point
from compare import differences, open_oracle

STATEMENTS = entry_point.oracle_sql()
QUERIES = entry_point.queries()
# the oracle gives the same rows for these, whatever the source
ROWS_ONLY = sorted(set(QUERIES) - set(STATEMENTS))


@pytest.fixture(scope="module")
def oracle(small):
    return open_oracle(small)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_oracle(spark, small, oracle, name):
    assert differences(QUERIES[name], STATEMENTS[name], spark, small, oracle) is None


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_query_without_oracle_returns_rows(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_comparison_notices_a_difference(spark, small, oracle):
    wrong = STATEMENTS["active_users"].replace("limit 5", "limit 4")
    assert wrong != STATEMENTS["active_users"]
    assert differences(QUERIES["active_users"], wrong, spark, small, oracle) is not None


def test_entry_returns_rows(spark):
    assert entry_point.entry(spark).count() == 10
