"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from tests.compare import compare


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query_matches_sql(spark, duck, small, name):
    assert compare(spark, duck, small, name) == ""


def test_oracles_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1
