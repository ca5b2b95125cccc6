"""Every registered query with SQL gives the rows that DuckDB gives."""

import glob
import os
from collections import Counter
from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as contract

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{ROOT}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def normal(value):
    if isinstance(value, float):
        return "double", repr(value)
    if isinstance(value, datetime):
        return "timestamp", value.isoformat()
    return type(value).__name__, str(value)


def bag(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, database, name):
    frame = contract.queries()[name](spark, ROOT)
    result = database.execute(contract.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(names)
    assert bag(frame.collect(), frame.columns) == bag(result.fetchall(), names)


@pytest.mark.parametrize(
    "name", sorted(set(contract.queries()) - set(contract.oracle_sql()))
)
def test_query_without_sql_runs(spark, name):
    assert contract.queries()[name](spark, ROOT).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
