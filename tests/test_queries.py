"""Every registered query against its SQL on the smallest sample."""

import duckdb
import pytest

import __spark_entry__ as entry
from cartpulse.plans import sample_oracle, sample_queries
from checks.compare import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(sample_queries.queries()) == set(sample_oracle.oracle_sql())
    assert set(sample_queries.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(sample_queries.queries()))
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_entry_runs(spark):
    result = entry.entry(spark)
    assert result.columns[0] == "product_id" and 0 < result.count() <= 5
