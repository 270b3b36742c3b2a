"""Every query with SQL against DuckDB on the smallest data."""

import pytest

import __spark_entry__ as contract
import check

SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return check.database(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, sf_dir, connection, name):
    assert check.compare(contract.queries()[name](spark, sf_dir), connection, SQL[name]) is None


def test_entry_has_rows_and_schema(spark):
    gold = contract.entry(spark)
    assert gold.columns == ["value_group", "outcome", "event_count", "avg_value", "avg_user"]
    assert gold.count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(contract.queries())
