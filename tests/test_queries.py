"""Every registered query against its SQL at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as driver
from check_queries import TABLES, rows_of
from hearthmill.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, sql, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    want = sql.execute(driver.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_flagship(spark):
    assert driver.entry(spark).count() > 0
