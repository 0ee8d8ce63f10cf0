"""Every registered query against its SQL twin, rows, types and values."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.parity import connect, differences
from tidemark.plans import oracle
from tidemark.plans.catalog import QUERIES

SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


def test_all_queries_have_a_twin():
    assert QUERIES.keys() == oracle.oracle_sql().keys()
    assert not SQL.keys() - queries().keys()


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, data, duck, name):
    assert differences(queries()[name](spark, data), duck, SQL[name]) == []


def test_entry(spark):
    assert {r["split"] for r in entry(spark).collect()} == {"train", "test", "oot"}
