"""Every registered query against its SQL counterpart, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, rows_of

# Names of the core's queries; the part on training data has tests of its own.
CORE = set(contract._shop_queries())
FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert CORE <= set(contract.queries())
    assert CORE <= set(ORACLE) <= set(contract.queries())


@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, db, name):
    frame = contract.queries()[name](spark, FOLDER)
    result = db.sql(ORACLE[name])
    assert sorted(frame.columns) == sorted(result.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(result.columns, result.fetchall())
    types = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN",
             "double": "DOUBLE"}
    assert {c: types[t] for c, t in frame.dtypes} == dict(
        zip(result.columns, map(str, result.types)))


def test_entry(spark):
    assert contract.entry(spark).columns == ["area", "product_name", "click_count", "remark", "rank"]
    assert contract.entry(spark).count() > 0
