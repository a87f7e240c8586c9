"""Every registered query against its SQL in DuckDB, and the given values of the gold table."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from tripstrata.plans.oracles import ORACLES
from tripstrata.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
TYPES = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp",
    "BOOLEAN": "boolean",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query(spark, duck, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    rows = df.collect()
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    expected = duck.sql(sql)
    assert sorted(df.columns) == sorted(expected.columns)
    assert dict(df.dtypes) == {c: TYPES[str(t)] for c, t in zip(expected.columns, expected.types)}
    assert _sorted(df.columns, rows) == _sorted(expected.columns, expected.fetchall())


def test_every_trip_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_flagship_values(spark):
    gold = entry_points.entry(spark)
    sums = gold.selectExpr(
        "count(*)", "sum(trip_count)", "sum(total_revenue)", "sum(total_passengers)",
        "count_if(zone = 'Unknown')", "count_if(borough = 'Unknown')",
    )
    assert tuple(sums.first()) == (858, 1000, 492478.0, 2935, 76, 109)
