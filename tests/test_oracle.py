"""Every registered query with SQL returns what the SQL returns, value by value."""

import os

import pytest

from foliospark.queries import load
from tests.oracle import connect, differences

QUERIES = load()
#: Takes minutes; `python -m tests.check sweep` or SLOW_TESTS=1 runs it, test_operators a smaller one.
SLOW = set() if os.environ.get("SLOW_TESTS") else {"sweep"}


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql is not None and n not in SLOW])
def test_query_equals_sql(spark, folder, con, name):
    q = QUERIES[name]
    assert differences(q.run(spark, folder), con, q.sql) == []


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
