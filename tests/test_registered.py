"""Every registered query gives the rows of its SQL."""

import pytest

import __spark_entry__ as entry_module
from harness import compare, connect
from oracles import all_oracles
from tradewind.registry import all_queries

QUERIES, SQL = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", list(QUERIES))
def test_rows_match(spark, duck, small, name):
    good, note = compare(spark, duck, small, QUERIES[name], SQL.get(name))
    assert good, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_everything_is_offered():
    assert set(QUERIES) <= set(entry_module.queries()) and set(SQL) <= set(entry_module.oracle_sql())


def test_entry(spark):
    assert entry_module.entry(spark).count() == 6
