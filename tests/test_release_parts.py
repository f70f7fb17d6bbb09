"""A release is dropped in as many parts as tasks write, and a report's parts are packed until they are joined."""

from pathlib import Path
from xml.etree import ElementTree

from palimpsest.plans import registered
from palimpsest.sources import sinks
from palimpsest.streaming.ingest import ingest


def test_a_streamed_release_has_many_parts(spark, tmp_path, monkeypatch):
    folders = []
    monkeypatch.setattr(registered, "ingest", lambda store, folder, *rest: folders.append(folder) or ingest(store, folder, *rest))
    spark.range(200).selectExpr("id AS doc_id", "concat('AC', id) AS text").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    assert registered.queries()["streamed_release"](spark, str(tmp_path)).count() == 180
    first = Path(folders[0].removeprefix("file:")) / "version=1"
    parts = [p for p in first.glob("part-*") if p.stat().st_size]
    assert len(parts) > 1 and (first / f"{len(parts)}.done").exists()


def test_parts_of_a_report_are_packed(spark, tmp_path, monkeypatch):
    seen, real = [], sinks.join_parts
    monkeypatch.setattr(sinks, "join_parts", lambda spark, parts, *rest: seen.extend(parts) or real(spark, parts, *rest))
    rows = spark.range(300).selectExpr("id div 3 + 1 AS iteration_no", "concat('q', id div 3) AS query_id", "10 AS query_len", "CAST(id % 3 + 1 AS int) AS hit_no", "'s' AS subject_id", "9 AS subject_len", "0 AS hsp_no",
                                       "5 AS align_length", "0.5D AS e_value", "4 AS identical", "3 AS positive", "2.0D AS hit", "1 AS query_start", "11 AS q_stop", "1 AS s_start", "10 AS s_stop")
    sinks.write_report(rows, f"{tmp_path}/report.xml", "blastp", parts=4)
    assert seen and all(p.endswith(".gz") for p in seen)
    root = ElementTree.parse(f"{tmp_path}/report.xml").getroot()
    assert [int(x.text) for x in root.iter("Iteration_iter-num")] == list(range(1, 101)) and len(list(root.iter("Hsp"))) == 300
