"""Every registered query against its SQL."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from eventmart.plans import oracle, queries
from tests.comparison import difference, oracle_connection

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SF_DIR)


def test_every_query_has_sql():
    assert set(queries.queries()) == set(oracle.oracle_sql())
    assert set(queries.queries()) <= set(driver.queries())
    assert set(oracle.oracle_sql()) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_matches_sql(spark, duck, name):
    query, sql = driver.queries()[name], driver.oracle_sql()[name]
    rows, differs = difference(spark, duck, query, sql, SF_DIR)
    assert not differs
    assert rows > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0
