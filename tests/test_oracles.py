"""Every registered query with SQL must equal it on the smallest tables."""

import pytest

import __spark_entry__ as contract
from tests.oracle import TABLES_DIR, compare, duck

SF_DIR = f"{TABLES_DIR}/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    result = contract.queries()[name](spark, SF_DIR)
    assert compare(result, connection, contract.oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1


def test_every_check_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
