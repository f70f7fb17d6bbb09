"""Operators that SQL can express, against DuckDB on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from palimpsest.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    df = queries.queries()[name](spark, SF)
    found = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(found)
