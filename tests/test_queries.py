"""Every registered query gives the rows of its SQL."""

from collections import Counter

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as contract
from palimpsest.checks.oracle import ORACLE
from palimpsest.checks.queries import QUERIES

TABLES = ("documents", "pages", "conversations")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    found = QUERIES[name](spark, SMALL)
    expected = database.sql(ORACLE[name])
    assert sorted(found.columns) == sorted(expected.columns)
    assert bag(found.collect(), found.columns) == bag(expected.fetchall(), expected.columns)


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "source_file", "project", "page_id", "page_title", "identifier_type", "identifier_id",
        "added_ts", "removed_ts",
    ]
