"""Every registered query against its SQL on an independent engine."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from showcase.oracle import ORACLE_SQL
from showcase.queries import QUERIES

FOLDER = os.environ.get("TEST_TABLES", "/root/testdata/sf0.01")
TABLES = ("region", "nation", "customer", "orders", "events")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_an_equivalent():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, engine, name):
    frame = contract.queries()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    found = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)
    cursor = engine.execute(contract.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted((tuple(row[i] for i in order) for row in cursor.fetchall()), key=repr)
    assert found == expected
    assert found, "a query that returns nothing proves nothing"
