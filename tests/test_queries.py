"""Every registered query gives the rows of its SQL twin."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from conftest import DATA

from fieldweave.workload import all_queries, all_sql  # isort: skip

QUERIES, ORACLES = all_queries(), all_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    _, fault = differences(QUERIES[name](spark, DATA), duck, ORACLES[name])
    assert not fault


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["id", "email", "name", "fields", "created_at", "total"]
    assert rows.count() > 0
