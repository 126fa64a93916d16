"""Every registered query against its SQL on the smallest tables."""

import decimal
import math

import duckdb
import pytest
from conftest import TABLES

import __spark_entry__ as entry_points
from tierflow.workload.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return str(value) if isinstance(value, decimal.Decimal) else value


def canonical(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, FOLDER)
    got = [tuple(r) for r in df.collect()]
    cursor = duck.execute(entry_points.oracle_sql()[name])
    types = {c[0]: str(c[1]) for c in cursor.description}
    wanted = cursor.fetchall()
    assert {c: SPARK_TO_DUCK[t] for c, t in df.dtypes} == types
    assert canonical(df.columns, got) == canonical(list(types), wanted)


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() > 0
