"""Every registered query against its SQL counterpart over the same Parquet files."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from faultline.plans.oracles import ORACLES
from faultline.plans.queries import QUERIES

TABLES = ["events"]


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in data)


@pytest.fixture(scope="session")
def duck():
    connections = {}

    def connect(sf_dir):
        if sf_dir not in connections:
            connection = duckdb.connect()
            for table in TABLES:
                connection.execute(
                    f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'"
                )
            connections[sf_dir] = connection
        return connections[sf_dir]

    return connect


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name, sf_dir):
    df = contract.queries()[name](spark, sf_dir)
    result = duck(sf_dir).execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = rows(columns, result.fetchall())
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    assert sum(got.values()) == sum(expected.values())
    assert got == expected


def test_entry(spark):
    assert contract.entry(spark).count() > 0
