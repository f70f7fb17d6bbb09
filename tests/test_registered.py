"""Every registered query against its SQL in DuckDB on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from palimpsest.plans import registered

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(rows):
    return sorted(tuple(str(None if x is None or x != x else x) for x in r) for r in rows)


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query(spark, duck, name):
    df = registered.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = plain(df.select(*[f"`{c}`" for c in columns]).collect())
    if name not in registered.oracle_sql():
        assert got
        return
    cursor = duck.execute(registered.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert got == plain([[r[names.index(c)] for c in columns] for r in cursor.fetchall()])


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["entry_key", "text_md5", "lang", "source"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
