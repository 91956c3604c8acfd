"""Every query against its SQL check on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from tallyfold.workload.oracles import ORACLES
from tallyfold.workload.queries import QUERIES

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for file in sorted(os.listdir(SMALL)):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{file}'")
    yield connection
    connection.close()


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_check(spark, engine, name):
    got = QUERIES[name](spark, SMALL)
    want = engine.sql(ORACLES[name])
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    order = [want.columns.index(c) for c in columns]
    expected = sorted(repr([row[i] for i in order]) for row in want.fetchall())
    found = sorted(repr(list(row)) for row in got.select(*columns).collect())
    assert found and found == expected


def test_entry(spark):
    assert entry.entry(spark).count() > 0
