"""Every registered query against its SQL twin."""

import pytest
from compare import SMALL, connect, differences

import __spark_entry__ as entry
from oracle.queries import statements
from tradewind.queries import QUERIES

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(statements())
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, SMALL), duck, SQL[name]) == []


def test_entry(spark):
    assert entry.entry(spark).columns == ["order_date", "product_id", "product_title", "revenue", "units", "orders"]
