"""Every registered query with SQL against DuckDB, on the smallest tables."""

from __future__ import annotations

import pytest
from compare import compare, duck

import __spark_entry__ as contract
from query_catalogue import ORACLE, QUERIES

PATH = "/root/testdata/sf0.001"
#: No category is rare, and no name is in both tables, in the smallest tables; larger ones give rows.
EMPTY_HERE = {"A6_consolidated_categories", "U7_names_in_both"}


@pytest.fixture(scope="module")
def con():
    return duck(PATH)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    verdict, _ = compare(spark, con, name, PATH)
    assert verdict == ("EMPTY" if name in EMPTY_HERE else "ok"), verdict


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(ORACLE) == set(QUERIES)
    assert contract.entry(spark).count() > 0
