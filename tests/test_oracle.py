"""Every registered query against its SQL in DuckDB, column by column and value by value."""

import pytest

import __spark_entry__ as contract
import check

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    with check.connect(SF_DIR) as con:
        yield con


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    assert check.compare(QUERIES[name](spark, SF_DIR), SQL[name], duck) == ""


def test_entry_returns_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
