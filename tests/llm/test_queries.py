"""The registered queries with SQL, over the smallest driver tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from martline.llm.catalog import QUERIES, SQL

DIR = Path("/root/testdata/sf0.001")


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for file in DIR.glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    df = QUERIES[name](spark, str(DIR))
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted(str([row[columns.index(c)] for c in sorted(columns)]) for row in result.fetchall())
    assert expected and sorted(str([r[c] for c in sorted(columns)]) for r in df.collect()) == expected
