"""Cells are stored by entry, and a read of one slice deals nothing."""

import pyarrow.parquet as pq

from palimpsest.store import Store


def test_an_entry_is_one_row_and_one_slice_is_read_where_it_lies(spark, tmp_path):
    rows = [(f"k{n}", {"ID": f">{n}", "SEQ": "A" * 100, "X": None, "Y": "y"}) for n in range(5)]
    store = Store(spark, str(tmp_path))
    store.put(spark.createDataFrame(rows, "entry_key string, fields map<string,string>"), "c", 1)
    stored = [pq.read_metadata(p).num_rows for p in (tmp_path / "cells").rglob("*.parquet")]
    assert sum(stored) == 5 and store.table("cells").count() == 15
    got = store.get("c", start=1).existing
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert {r.entry_key: r.fields for r in got.collect()} == {k: {f: v for f, v in fields.items() if v} for k, fields in rows}
