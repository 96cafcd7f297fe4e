"""Every registered query against its SQL, on whole tables."""

import pytest
from compare import assert_same, connect

import __spark_entry__ as entry
import bindings

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


def test_every_query_has_an_oracle():
    # The corpus queries have tests of their own; they may be absent.
    own = set(bindings.QUERIES)
    assert own <= set(ORACLES)
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(ORACLES) & set(bindings.QUERIES)))
def test_query_agrees_with_sql(spark, folder, connection, name):
    assert_same(QUERIES[name](spark, folder), connection, ORACLES[name])


def test_entry(spark):
    assert entry.entry(spark).count() > 0
