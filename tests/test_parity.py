"""Every registered query equals its SQL twin on the smallest driver tables."""

import pytest
from parity import connect, differences

import __spark_entry__ as entry_point
from tallyreel import catalog

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {name: query for name, query in entry_point.queries().items() if name in catalog.PLANS}
SQL = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(catalog.PLANS)
    assert set(QUERIES) <= set(SQL) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_parity(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, SQL[name]) == []


def test_entry(spark):
    assert entry_point.entry(spark).count() == 150
