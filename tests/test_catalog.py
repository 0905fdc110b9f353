"""Every registered query against its check SQL on the given tables."""

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries
from hemeroteca.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_a_check():
    assert set(ORACLES) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_check(spark, sf, con, name):
    assert difference(spark, con, queries()[name], oracle_sql()[name], sf) is None
