"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from tidelog.workload.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["events", "orders", "documents"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, database, name):
    found = entry_point.queries()[name](spark, SF_DIR)
    expected = database.execute(entry_point.oracle_sql()[name])
    columns = [column[0] for column in expected.description]
    assert canonical(found.columns, found.collect()) == canonical(columns, expected.fetchall())


def test_entry(spark):
    assert entry_point.entry(spark).count() == 290
