"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from logweir.suite import QUERIES, SQL
from tests.compare import connect, spark_bag, sql_bag

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = contract.queries()[name](spark, FOLDER)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    columns, rows = spark_bag(result)
    expected_columns, expected_rows = sql_bag(duck, contract.oracle_sql()[name])
    assert columns == expected_columns
    assert rows == expected_rows
    assert rows


def test_entry(spark):
    assert contract.entry(spark).count() > 0
