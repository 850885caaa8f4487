"""Every query with SQL against DuckDB on the smallest tables, and the driver's contract."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as contract
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_contract(spark):
    queries, oracle = contract.queries(), contract.oracle_sql()
    assert set(oracle) <= set(queries)
    own = set(queries) - set(contract.LLM_QUERIES)
    assert own - set(oracle) == set()
    assert contract.entry(spark).columns == ["order_day", "revenue"]


@pytest.mark.parametrize("name", sorted(set(contract.oracle_sql()) - set(contract.LLM_QUERIES)))
def test_same_as_duckdb(spark, duck, name):
    assert differences(contract.queries()[name](spark, SF_DIR), duck, contract.oracle_sql()[name]) == []
