"""Every query against its SQL equivalent over the smallest tables."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as contract
from tidewatch import catalog
from tidewatch.catalog.base import TABLES

SMALL = "/root/testdata/sf0.001"
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return None if math.isnan(value) else round(float(value), 6)
    return value


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(row[c]) for c in columns) for row in df.collect()), key=repr)
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(row[names.index(c)]) for c in columns) for row in cursor.fetchall()), key=repr)
    assert got == want


def test_every_query_of_the_catalogue_has_sql():
    assert set(catalog.entries()) <= set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).columns
