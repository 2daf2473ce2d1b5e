"""Every registered query against its SQL on the smallest scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry
from compare import TABLES, rows_of

from sensorwarden.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).columns == ["id", "node_id", "event", "severity", "description", "timestamp"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    frame = entry.queries()[name](spark, SF)
    result = db.execute(entry.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(names, result.fetchall())
