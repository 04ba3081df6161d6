"""Every registered query against its SQL, over the whole smallest driver tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from martline.plans.catalog import QUERIES
from martline.plans.oracle import SQL

DIR = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not DIR.exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in DIR.glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple((row[i] is not None, str(row[i])) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, str(DIR))
    result = oracle.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    expected = normal(columns, result.fetchall())
    assert expected, "a check over no rows proves nothing"
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_entry(spark):
    assert contract.entry(spark).count() > 0
