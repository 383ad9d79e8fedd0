"""Every registered query against its SQL in DuckDB, over whole tables."""

import os
from glob import glob

import duckdb
import pytest

import __spark_entry__ as entry
from snaptrack.registry import oracle, spark_queries
from tests.compare import duck_rows, spark_rows

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def test_each_query_has_an_oracle():
    assert set(spark_queries.queries()) == set(oracle.oracle_sql())
    assert set(entry.queries()) >= set(spark_queries.queries())


@pytest.mark.parametrize("name", sorted(spark_queries.queries()))
def test_matches_oracle(spark, duck, name):
    columns, rows = spark_rows(entry.queries()[name](spark, SF_DIR))
    expected_columns, expected = duck_rows(duck, entry.oracle_sql()[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
    assert rows


def test_entry(spark):
    assert entry.entry(spark).count() > 0
