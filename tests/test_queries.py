"""Every registered query against its SQL twin, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from showcase.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return con


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert entry_points.oracle_sql().keys() <= entry_points.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = duck.execute(entry_points.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in result.description}
    assert columns == sorted(types)
    assert {c: TYPES[df.schema[c].dataType.simpleString()] for c in columns} == types
    place = [list(types).index(c) for c in columns]
    expected = [tuple(row[i] for i in place) for row in result.fetchall()]
    got = [tuple(row) for row in df.select(*columns).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_entry(spark):
    df = entry_points.entry(spark)
    assert sorted(df.columns) == ["amount_bucket", "country", "order_count", "total_amount"]
    assert not df.isEmpty()
