"""Every registered query of the market-data operators against its SQL on DuckDB, at the smallest scale."""

import decimal
import math

import duckdb
import pytest

from tidemark.plans import registry

registry.load()
FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "null"
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return str(value)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(name, spark, duck):
    got = registry.QUERIES[name](spark, FOLDER)
    want = duck.sql(registry.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    ours = sorted([plain(v) for v in row] for row in got.select(*columns).collect())
    theirs = sorted([plain(v) for v in row] for row in want.select(*[f'"{c}"' for c in columns]).fetchall())
    assert ours == theirs


def test_query_without_sql(spark):
    rows = registry.QUERIES["E18_cadence_episodes"](spark, FOLDER)
    assert rows.count() > 0
