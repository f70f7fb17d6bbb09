"""Files are listed by tasks, and their number does not make the number of tasks."""

import os

import pytest
from pyspark.sql import functions as F

from palimpsest.sources import files


def test_tasks_list_folders(spark, tmp_path):
    names = {"a.txt": 1, "empty": 0, "b é%20+.txt": 2, "s/inner.txt": 3, "s/t/u/v/w.txt": 4, "s/k=1/_x=2/y.txt": 5, "_metadata": 6}
    hidden = [".a", "_b", "s/.hidden/c", "s/_tmp/d", "e._COPYING_"]
    for name, size in {**names, **dict.fromkeys(hidden, 9)}.items():
        os.makedirs((tmp_path / name).parent, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * size)
    found = files.listed(spark, f"{tmp_path}/")
    assert {r.below: (r.size, r.path) for r in found.collect()} == {n: (size, f"file:{tmp_path}/{n}") for n, size in names.items()}
    assert {r.below for r in files.listed(spark, f"{tmp_path}/s").collect()} == {n[2:] for n in names if n.startswith("s/")}
    with pytest.raises(Exception, match="none"):
        files.listed(spark, f"{tmp_path}/none").collect()


def test_many_files_make_no_more_tasks(spark, tmp_path):
    counts = []
    for n in (1, 1500):
        rows = spark.range(n).select(F.concat(F.lit("p/"), "id").alias("path"), F.encode(F.col("id").cast("string"), "UTF-8").alias("content"))
        assert files.write_files(rows, f"{tmp_path}/{n}").count() == n
        found = files.measured(files.listed(spark, f"{tmp_path}/{n}"))
        assert found.count() == n
        counts.append(found.rdd.getNumPartitions())
    assert counts[0] == counts[1] and counts[0] > 1  # more than one task hashes, however few bytes the rows are


def test_a_write_that_dies_leaves_nothing_to_list(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a").write_text("a")
    found = files.listed(spark, f"{tmp_path}/in").union(spark.createDataFrame([("/none", "b", 1)], "path string, below string, size long")).coalesce(1)
    with pytest.raises(Exception, match="none"):
        files.measured(found, f"{tmp_path}/out").collect()
    blocked = spark.createDataFrame([("c", b"c"), ("c/d", b"d")], "path string, content binary").coalesce(1)
    with pytest.raises(Exception, match="c"):
        files.write_files(blocked, f"{tmp_path}/out").collect()
    assert {r.below for r in files.listed(spark, f"{tmp_path}/out").collect()} <= {"a", "c"}
    assert not [n for n in os.listdir(tmp_path / "out") if n.endswith(".part")]


def test_a_copy_is_dealt_to_as_many_tasks_whatever_the_manifest(spark, tmp_path):
    rows = spark.range(700).select(F.concat(F.lit("p/"), "id").alias("path"), F.encode(F.col("id").cast("string"), "UTF-8").alias("content"))
    files.write_files(rows, f"{tmp_path}/in").count()
    counts = []
    for n in (1, 700):
        copied = files.copy_files(rows.select("path").where(F.col("path").isin(*[f"p/{k}" for k in range(n)])), f"{tmp_path}/in", f"{tmp_path}/out{n}")
        assert {(r.path, r.size) for r in copied.collect()} == {(f"p/{k}", len(str(k))) for k in range(n)}
        assert sorted(os.listdir(tmp_path / f"out{n}")) == ["p"] and len(os.listdir(tmp_path / f"out{n}/p")) == n
        counts.append(copied.rdd.getNumPartitions())
    assert counts == [4 * spark.sparkContext.defaultParallelism] * 2
