"""A report is read by ranges of its bytes, whatever falls to their borders."""

from pathlib import Path
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from palimpsest.plans import registered
from palimpsest.sources import files, sinks

SF = "/root/testdata/sf0.001"


def parsed(text: str) -> list[tuple]:
    """(iteration, query, hit, its text, HSP, e-value) of each HSP, by another parser."""
    number = lambda value, kind: kind(value) if value else None
    return [
        (number(i.findtext("Iteration_iter-num"), int), i.findtext("Iteration_query-def"), number(h.findtext("Hit_num"), int), h.findtext("Hit_def"), number(p.findtext("Hsp_num"), int), number(p.findtext("Hsp_evalue"), float))
        for i in ElementTree.fromstring(text).iter("Iteration") for h in i.iter("Hit") for p in h.iter("Hsp")
    ]


def read(spark, path) -> list[tuple]:
    rows = files.read_report(spark, f"file:{path}").select("iteration_no", "query_id", "hit_no", "hit_def", "hsp_no", "e_value", "program").collect()
    assert {r.program for r in rows} <= {"blastp & x"}
    return [tuple(r)[:-1] for r in rows]


@pytest.fixture
def report(tmp_path) -> Path:
    """Iterations without hits, hits without HSPs, elements that are empty, missing or escaped, and one query with most HSPs."""
    hsp = lambda k, more="": f"<Hsp><Hsp_num>{k}</Hsp_num>{more}</Hsp>\n"
    hit = lambda k, name, *hsps: f"<Hit><Hit_num>{k}</Hit_num><Hit_def>{name}</Hit_def><Hit_len>9</Hit_len><Hit_hsps>{''.join(hsps)}</Hit_hsps></Hit>"
    iteration = lambda k, name, *hits: f"  <Iteration>\n<Iteration_iter-num>{k}</Iteration_iter-num><Iteration_query-def>{name}</Iteration_query-def><Iteration_hits>{''.join(hits)}</Iteration_hits></Iteration>"
    parts = [
        iteration(1, "none"),
        iteration(2, "a &lt;é&gt; &amp;lt;", hit(1, "x &amp; y", hsp(0, "<Hsp_evalue>1.0E-30</Hsp_evalue>"), hsp(1, "<Hsp_evalue></Hsp_evalue>")), hit(2, "no HSPs"), hit(3, "&#233;&quot;&amp;#65;", hsp(0))),
        iteration(3, "no hits"),
        iteration(4, "all", *[hit(k, f"s{k}", *[hsp(j, "<Hsp_evalue>5</Hsp_evalue>") for j in range(k % 3)]) for k in range(1, 40)], hit(40, "long", *[hsp(j) for j in range(60)])),
        iteration(5, "end", hit(1, "z", hsp(0))),
    ]
    path = tmp_path / "report.xml"
    path.write_text(f'<?xml version="1.0"?>\n<BlastOutput><BlastOutput_program>blastp &amp; x</BlastOutput_program><BlastOutput_iterations>{"".join(parts)}</BlastOutput_iterations></BlastOutput>\n')
    return path


@pytest.mark.parametrize("size", [37, 300, 1 << 20])
def test_heads_are_carried_over_ranges(spark, report, monkeypatch, size):
    monkeypatch.setattr(files, "RANGE", size)
    got, expected = read(spark, report), parsed(report.read_text())
    assert len(expected) > 90 and sorted(got, key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("block", [1, 5, 64, 1 << 20])
def test_ranges_have_every_byte_once(report, monkeypatch, block):
    monkeypatch.setattr(files, "BLOCK", block)
    text = report.read_bytes()
    for size in (3, 50, 701, 1 << 20):
        texts = [t for begin in range(0, len(text), size) for t in files._report_texts(str(report), begin, begin + size)]
        assert b"".join(texts) == text and all(t.startswith(b"<Hsp>") for t in texts[1:])


def test_what_ranges_would_misread_is_refused(report):
    text = report.read_bytes()
    for hidden in (b"<![CDATA[<Hsp>]]>", b"<!-- <Hsp> -->"):
        with pytest.raises(ValueError, match="not read by ranges"):
            files._hsps(text.replace(b"</Hit>", hidden + b"</Hit>", 1))


def test_a_report_without_rows(spark, tmp_path):
    columns = "iteration_no long, query_id string, query_len int, hit_no int, subject_id string, subject_len int, hsp_no int, align_length int, e_value double, identical int, positive int, hit double, query_start int, q_stop int, s_start int, s_stop int"
    sinks.write_report(spark.createDataFrame([], columns), f"{tmp_path}/report.xml", "blastp")
    assert [*ElementTree.parse(f"{tmp_path}/report.xml").getroot().iter("Iteration")] == []
    assert files.read_report(spark, f"file:{tmp_path}/report.xml").collect() == []


def test_the_registered_report_is_read_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(files, "RANGE", 200_000, raising=False)
    tasks = registered.queries()["report_document"](spark, SF).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
    assert len(tasks) > 10 and max(t.n for t in tasks) < 1000
