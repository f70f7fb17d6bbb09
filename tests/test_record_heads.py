"""Records are cut without dealing their text by file."""

import gzip

import pytest

from palimpsest.sources.records import read_records


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", 200)
    spark.conf.set("spark.sql.files.openCostInBytes", 50)
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_lines_before_the_first_record_go_without_dealing_text(spark, tmp_path, small_splits):
    wanted = []
    for k in range(12):
        bodies = [f"{k}.{n}\n" + "ACGT" * (n % 7) for n in range(30 * (k % 3) + 1)]
        wanted += bodies
        text = ("", "; first\n; second\n", "\n")[k % 3] + "".join(f">{b}\n" for b in bodies)
        (tmp_path / f"{k}.fa").write_text(text) if k % 2 else (tmp_path / f"{k}.fa.gz").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "only.fa").write_text("; nothing else")
    rows = read_records(spark, str(tmp_path), "\n>", ">")
    got = [r.record.strip().removeprefix(">").rstrip("\n") for r in rows.collect()]
    assert sorted(got) == sorted(b.rstrip("\n") for b in wanted)
    assert rows.select("block").distinct().count() > 1
    plan = read_records(spark, str(tmp_path), "\n>", ">")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 2 and "SortMergeJoin" not in plan and "SortAggregate" not in plan
