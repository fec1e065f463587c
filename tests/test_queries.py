"""Every registered query next to its SQL; the others by their invariants."""

import pytest
from compare import difference, duck
from helpers import SF_DIR

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def database():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_equals_sql(spark, database, name):
    query, sql = contract.queries()[name], contract.oracle_sql()[name]
    assert difference(spark, database, query, sql, SF_DIR) is None


def test_every_check_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["doc_id", "rank", "token", "weight"]
    assert result.filter("rank = 1").count() == 199
