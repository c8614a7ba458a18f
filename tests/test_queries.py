"""Every query of the library against its SQL, and the whole run again on more data."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import duckdb_tables, spark_rows, sql_rows
from checks.queries import BATCH_QUERIES, FIRST_RELEASE_BATCH, QUERIES
from checks.sql_operators import statements
from tests.conftest import TESTDATA

SQL = statements(BATCH_QUERIES, FIRST_RELEASE_BATCH)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, small_dir, small_sql, name):
    result = QUERIES[name](spark, small_dir)
    names, wanted = sql_rows(small_sql, SQL[name])
    assert sorted(result.columns) == names
    assert spark_rows(result) == wanted


@pytest.mark.parametrize("name", ["history_all_populations", "c07_lmn_addin_release"])
def test_query_equals_sql_on_more_data(spark, name):
    sf_dir = f"{TESTDATA}/sf0.01"
    wanted = sql_rows(duckdb_tables(sf_dir), SQL[name])[1]
    assert wanted and spark_rows(QUERIES[name](spark, sf_dir)) == wanted


def test_entry_returns_rows(spark):
    assert entry(spark).limit(1).count() == 1
