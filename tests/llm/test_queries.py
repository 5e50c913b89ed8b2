"""The training-data queries against their SQL, and the pipeline's and the others' first rows."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from eventmart.llm import oracle
from tests.comparison import difference, oracle_connection

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_matches_sql(spark, duck, name):
    rows, differs = difference(spark, duck, driver.queries()[name], driver.oracle_sql()[name], SF_DIR)
    assert not differs
    assert rows > 0


def test_all_operators_and_the_pipeline_are_registered():
    names = {n.split("_")[0] for n in driver.queries() if n.startswith("op") and n[2].isdigit()}
    assert names == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in driver.queries()
