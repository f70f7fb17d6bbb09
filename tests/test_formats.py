"""Formats, record cutting, sinks and the file table on small literal texts."""

import dataclasses
import gzip
import random
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from palimpsest.functions.checkpoints import numbered
from palimpsest.operators import filters, hits, lineage, manifest
from palimpsest.operators.counts import base_pairs
from palimpsest.sources import files, records, sinks
from palimpsest.sources.formats import FORMATS


def parsed(spark, name, text, tmp_path):
    (tmp_path / "in.txt").write_text(text)
    return {r.entry_key: r.fields for r in FORMATS[name].read(spark, str(tmp_path / "in.txt")).collect()}


def rendered(spark, name, fields, kind=None, addendum=""):
    df = spark.createDataFrame([(fields,)], "fields map<string,string>")
    return FORMATS[name].rendered(df, kind, addendum).first().text


def test_fasta(spark, tmp_path):
    got = parsed(spark, "fasta", ">a one\nACGT\n  GG \n>b two\nTT TT\n>c", tmp_path)
    assert got == {">a one": {"ID": ">a one", "SEQ": "ACGTGG"}, ">b two": {"ID": ">b two", "SEQ": "TT TT"}, ">c": {"ID": ">c", "SEQ": ""}}
    assert rendered(spark, "fasta", got[">b two"]) == ">b two\nTTTT"


def test_uniprot(spark, tmp_path):
    text = "ID   AB_X   Reviewed;  3 AA.\nAC   P1;\nAC   P2;\nSQ   SEQ\n     MKV LLL\n//\nID   CD_Y   Reviewed.\nbad\n//\n"
    got = parsed(spark, "uniprot", text, tmp_path)
    assert list(got) == ["AB_X   Revie"] and got["AB_X   Revie"]["AC"] == "P1;\nP2;"
    fields = got["AB_X   Revie"]
    assert rendered(spark, "uniprot", fields, "FASTA", "taxon") == ">AB_X   Reviewed;  3 AA. taxon\nMKVLLL"
    assert rendered(spark, "uniprot", fields, "DAT") == "ID   AB_X   Reviewed;  3 AA.\nAC   P1;\nAC   P2;\nSQ   SEQ\n     MKV LLL\n//"
    rejects = FORMATS["uniprot"].rejected(records.read_records(spark, str(tmp_path / "in.txt"), "\n//\n"))
    assert rejects.count() == 1


def test_line_formats(spark, tmp_path):
    hmm = "HMMER3/f x\nNAME  Globin\nLENG  4\n  1.0 2.0\nHMMER3/f y\nNAME  Other"
    got = parsed(spark, "hmm", hmm, tmp_path)
    assert set(got) == {"Globin", "Other"} and rendered(spark, "hmm", got["Globin"]) == "HMMER3/f x\nNAME  Globin\nLENG  4\n  1.0 2.0"
    pfam = "# STOCKHOLM 1.0\n#=GF ID 14-3-3\nseq1      ACG\nab\n//\n"
    got = parsed(spark, "pfam", pfam, tmp_path)
    assert rendered(spark, "pfam", got["14-3-3"]) == pfam.strip()
    got = parsed(spark, "glimmer", ">g1\norf1 1 2\norf2 3 4\n", tmp_path)
    assert rendered(spark, "glimmer", got[">g1"]) == ">g1\norf1 1 2\norf2 3 4"


def test_tables(spark, tmp_path):
    row = "\t".join(["q", "s", "99.0", "10", "1", "0", "1", "10", "1", "10", "0.001", "55"])
    got = parsed(spark, "blastoutput", f"{row}\nshort\tline\n", tmp_path)
    assert list(got) == [row] and rendered(spark, "blastoutput", got[row]) == row
    domain = " ".join(str(i) for i in range(22)) + " the rest of it"
    got = parsed(spark, "hmmeroutput", f"# comment\n{domain}\n", tmp_path)
    assert got[domain]["description"] == "the rest of it" and got[domain]["dom_score"] == "13"
    got = parsed(spark, "fullfile", "/a/b.txt\thash\t3\ttarget\t/a\tb.txt\n", tmp_path)
    assert rendered(spark, "fullfile", got["target/b.txt"]) == "/a/b.txt\tb.txt\ttarget/b.txt"
    assert rendered(spark, "priam", got["target/b.txt"]) == "target/b.txt\tb.txt"


def test_records(spark, tmp_path):
    with gzip.open(tmp_path / "x.fa.gz", "wt") as f:
        f.write("skip\nBEGIN 1\na\nEND\nlost\nBEGIN 2\nb")
    got = records.read_records_by_pattern(spark, str(tmp_path / "x.fa.gz"), "BEGIN.*", "END").orderBy("ordinal").collect()
    assert [r.record for r in got] == ["BEGIN 1\na", "BEGIN 2\nb"]


def test_line_ends_and_preambles(spark, tmp_path):
    (tmp_path / "a.fa").write_bytes(b"; a comment\r\n; more\r\n>x one\r\nAC\r\nGT\r\n>y\r\nT\r\n")
    (tmp_path / "b.fa").write_bytes(b">z\nA\n")
    (tmp_path / "c.fa").write_bytes(b"nothing here\n")
    got = {r.entry_key: r.fields["SEQ"] for r in FORMATS["fasta"].read(spark, str(tmp_path / "*.fa")).collect()}
    assert got == {">x one": "ACGT", ">y": "T", ">z": "A"}
    (tmp_path / "u.dat").write_bytes(b"ID   A1\r\nDE   one\r\n     ACGT\r\n//\r\nID   B2\r\nDE   two\r\n//\r\n")
    got = {r.entry_key: r.fields for r in FORMATS["uniprot"].read(spark, str(tmp_path / "u.dat")).collect()}
    assert got == {"A1": {"ID": "A1", "DE": "one", "SE": "ACGT", "#order": "ID,DE,SE"}, "B2": {"ID": "B2", "DE": "two", "#order": "ID,DE"}}
    (tmp_path / "p.sto").write_bytes(b"# STOCKHOLM 1.0\r\n#=GF ID   F1\r\ns/1 AC\r\n//\r\n# STOCKHOLM 1.0\r\n#=GF ID   F2\r\n//\r\n")
    assert {r.entry_key for r in FORMATS["pfam"].read(spark, str(tmp_path / "p.sto")).collect()} == {"F1", "F2"}


def test_post_hook(spark):
    shout = dataclasses.replace(FORMATS["fasta"], post=lambda df: df.withColumn("text", F.upper("text")))
    entries = spark.createDataFrame([("a", {"ID": ">a", "SEQ": "ac gt"})], "entry_key string, fields map<string,string>")
    assert [r.text for r in shout.rendered(entries).collect()] == [">A\nACGT"]


def test_numbered(spark):
    rows = spark.range(0, 1000).select((F.col("id") * 37 % 1000).alias("v"))
    assert sorted((r.v, r.rank) for r in numbered(rows, "rank", F.col("v")).collect()) == [(i, i + 1) for i in range(1000)]
    assert numbered(rows.limit(0), "rank", F.col("v")).collect() == []


def test_filters():
    assert filters.parse_filter("ID=a=b,c,OS=.*x") == {"ID": "a=b,c", "OS": ".*x"}
    assert filters.parse_filter({"A": "b"}) == {"A": "b"} and filters.parse_filter(None) == {}


def test_islands(spark):
    base = ("s", 90.0, 10, 1, 0, 1, 11, 1, 11, 0.1, 5.0)
    other = ("s", 80.0, 10, 1, 0, 1, 11, 1, 11, 0.1, 5.0)
    last = ("t", *base[1:])
    rows = [("q", *r, n) for n, r in enumerate([base, other, base, last, base])] + [("r", *base, 9)]
    df = spark.createDataFrame(rows, hits.HIT_SCHEMA + ", line_no long")
    got = [(r.query_id, r.line_no, r.iteration_no, r.hit_no, r.hsp_no) for r in hits.iterations(hits.islands(df)).orderBy("query_id", "line_no").collect()]
    assert got == [("q", 0, 1, 1, 0), ("q", 2, 1, 1, 1), ("q", 3, 1, 2, 0), ("q", 4, 1, 3, 0), ("r", 9, 2, 1, 0)]
    assert hits.islands(df, keep="all_hsps").count() == 6


def test_xml_and_text(spark, tmp_path):
    row = ("q", "s", 90.0, 10, 1, 0, 1, 11, 1, 11, 0.1, 5.0, 0)
    df = spark.createDataFrame([row], hits.HIT_SCHEMA + ", line_no long")
    sinks.write_xml(hits.nested(hits.iterations(hits.islands(df)), "taxon"), str(tmp_path / "x"))
    text = "".join(p.read_text() for p in (tmp_path / "x").glob("part-*"))
    assert "<Iteration_hits>" in text and "<Hit_def>s taxon</Hit_def>" in text and text.count("<Hsp>") == 1
    rows = spark.createDataFrame([("b", "x"), ("a", "y"), ("c", "")], "entry_key string, text string")
    assert [r.value for r in sinks.key_value_lines(rows, "entry_key", "text").collect()] == ["b\nx", "a\ny", "c"]
    report = spark.createDataFrame([("g", 1, "x"), ("f", 2, "y"), ("f", 1, "z")], "file string, n int, v string")
    assert [r.v for r in sinks.sorted_report(report, "n").collect()] == ["z", "y", "x"]
    parts = sinks.split_sorted(rows, 2).withColumn("p", F.spark_partition_id()).withColumn("n", sinks.split_number(F.col("entry_key"), 2)).collect()
    assert all(r.p == r.n for r in parts)
    assert sinks.result_digest(rows) == sinks.result_digest(rows.orderBy(F.desc("text")))


def test_manifest(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/a.txt").write_text("one")
    found = manifest.from_folder(spark, str(tmp_path / "d"), 1)
    assert [(r.size, r.version) for r in found.collect()] == [(3, 1)]
    log = spark.createDataFrame([("d/a", 1, False), ("d/a", 2, True), ("d/a", 3, False), ("d/e/b", 1, False), ("d/c", 2, True)], "path string, version long, is_deleted boolean")
    now = manifest.newest_state(log)
    assert [r.suffix for r in manifest.ls(now, "d").collect()] == ["a"]
    assert sorted(r.suffix for r in manifest.ls_rec(now, "d/").collect()) == ["a", "e/b"]
    gone = manifest.soft_delete(now, "d/a", 4)
    assert {r.path for r in manifest.live(gone).collect()} == {"d/e/b"}
    asked = spark.createDataFrame([("d/e/b/x",), ("z",)], "path string")
    got = {r.path: r.super_path for r in manifest.super_paths(asked, spark.createDataFrame([("d",), ("d/e",)], "path string")).collect()}
    assert got == {"d/e/b/x": "d/e", "z": None}
    known = spark.createDataFrame([("p", 1)], "path string, n int")
    new = spark.createDataFrame([("p", 2), ("q", 3)], "path string, n int")
    assert sorted(map(tuple, lineage.append_paths(known, new).collect())) == [("p", 1), ("q", 3)]


def test_plain_files(spark, tmp_path):
    (tmp_path / "seq/sub").mkdir(parents=True)
    (tmp_path / "seq/a.fna").write_text(">x\nACG\nT\n>y\nGG\n")
    (tmp_path / "seq/sub/b.fna").write_text(">z\nA\n")
    (tmp_path / "seq/c.txt").write_text(">no\nA\n")
    lines = files.read_sequence_lines(spark, str(tmp_path / "seq"))
    got = {r.file and r.file.rsplit("/", 1)[1]: (r.base_pairs, r.contigs, r.files, r.mean_length) for r in base_pairs(lines).collect()}
    assert got == {"a.fna": (6, 2, 1, 3), "b.fna": (1, 1, 1, 1), None: (7, 3, 2, 2)}
    files.concatenate_sequences(spark, str(tmp_path / "seq"), str(tmp_path / "all"), single=True)
    assert (tmp_path / "all").read_text().count(">") == 3
    row = "q\ts\t90\t10\t1\t0\t1\t11\t1\t11\t0.1\t5"
    (tmp_path / "hits.tsv").write_text(f"{row}\nbad\trow\n{row}\n")
    hit_rows = files.read_hits(spark, str(tmp_path / "hits.tsv"))
    assert [r.hsp_no for r in hits.islands(hit_rows, part=("file",)).orderBy("line_no").collect()] == [0, 1]
    (tmp_path / "gone.txt").write_text("s\n\ns\n")
    assert hits.correct(hit_rows, files.read_deleted(spark, str(tmp_path / "gone.txt")), F.lit(4), F.lit(2)).count() == 0
    meta = spark.createDataFrame([("t", 2, 4, "FASTA", "x")], "table_name string, inc_entries long, full_entries long, type string, taxon string")
    files.write_metadata(meta, str(tmp_path / "meta"))
    back = {r.key: r.value for r in files.read_metadata(spark, str(tmp_path / "meta")).collect()}
    assert back["FULL_ENTRIES"] == "4" and back["TABLE_NAME"] == "t"
    chosen = spark.createDataFrame([("sub/b.fna",)], "path string")
    for _ in range(2):
        assert [(r.path, r.size) for r in files.copy_files(chosen, str(tmp_path / "seq"), str(tmp_path / "copy")).collect()] == [("sub/b.fna", 5)]
    assert [p.name for p in (tmp_path / "copy").rglob("*") if p.is_file()] == ["b.fna"] and (tmp_path / "copy/sub/b.fna").read_text() == ">z\nA\n"


@pytest.mark.parametrize("seed", [1, 2])
def test_pattern_bounds_over_any_splits(spark, tmp_path, seed):
    rng = random.Random(seed)
    lines = lambda n: [rng.choice(["start", "start x", "end", "", "a" * rng.randrange(40), "startle"]) for _ in range(n)]
    files = {f"f{k}.txt": lines(rng.randrange(120)) for k in range(3)} | {"long.txt": ["start", *["b" * 30] * 200, "start"], "none.txt": ["x"] * 50}
    expected = {}
    for name, text in files.items():
        (tmp_path / name).write_text("\n".join(text) + "\n")
        found = []
        for line in text:
            if line in ("start", "start x"):
                found.append([])
            if found:
                found[-1].append(line)
        expected[name] = ["\n".join(r[: r.index("end")] if "end" in r else r) for r in found]
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in (37, 150, 4_000_000):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            got = {}
            for r in records.read_records_by_pattern(spark, str(tmp_path), "start( x)?", "end").orderBy("file", "block", "ordinal").collect():
                got.setdefault(r.file.rsplit("/", 1)[1], []).append(r.record)
            assert got == {k: v for k, v in expected.items() if v}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def plain_islands(rows, keep):
    """rows of (query, subject, score) in order, of one query after the other."""
    out, island, hsp, first, last = [], 0, 0, None, None
    for line, (query, subject, score) in enumerate(rows):
        if last is None or last[0] != query:
            island = 0
        if last != (query, subject):
            island, hsp, first = island + 1, 0, score
        last = (query, subject)
        if keep == "all_hsps" or score == first:
            out.append((line, island, hsp))
            hsp += 1
    return out


@pytest.mark.parametrize("keep", ["first", "all_hsps"])
def test_islands_over_many_ranges(spark, keep):
    rng = random.Random(7)
    rows = []
    for query, n in [("a", 3), ("b", 700), ("c", 1), ("d", 0), ("e", 40)]:  # one query has nearly all rows, and one island hundreds
        while n > 0:
            run = min(n, rng.choice([1, 2, 3, 5, 300]))
            subject = rng.choice("xyz")
            rows += [(query, subject, rng.choice([1.0, 1.0, 2.0, None])) for _ in range(run)]
            n -= run
    table = spark.createDataFrame([(q, s, 1.0, 5, 0, 0, 1, 9, 1, 9, 0.1, x, i) for i, (q, s, x) in enumerate(rows)], hits.HIT_SCHEMA + ", line_no long")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (4, 60):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = hits.islands(table.repartition(3), keep=keep)
            assert sorted((r.line_no, r.hit_no, r.hsp_no) for r in got.collect()) == plain_islands(rows, keep)
        sizes = [r.n for r in hits.islands(table, keep="all_hsps").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert max(sizes) < 60  # the hot query is spread
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert hits.islands(table.limit(0), keep=keep).collect() == []


def test_one_document_by_many_tasks(spark, tmp_path):
    rows = [(f"q<{q}>", f"s&{s}\x01", 90.0 + h, 10, 1, 0, 1, 11, 1, 11, 1e-30, float(h)) for q in range(6) for s in range(1 + q * 3 % 5) for h in range(1 + (q + s) % 3)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], hits.HIT_SCHEMA + ", line_no long")
    numbered_rows = hits.iterations(hits.islands(df, keep="all_hsps"), hits=df)
    texts = []
    for parts in (1, 7):
        sinks.write_report(numbered_rows, str(tmp_path / f"{parts}.xml"), "blastp", "A & B", parts)
        texts.append((tmp_path / f"{parts}.xml").read_text())
    root = ElementTree.fromstring(texts[0])
    assert texts[0] == texts[1] and root.tag == "BlastOutput" and root.findtext("BlastOutput_program") == "blastp"
    got = [(i.findtext("Iteration_query-def"), h.findtext("Hit_def"), int(p.findtext("Hsp_num")), float(p.findtext("Hsp_score"))) for i in root.iter("Iteration") for h in i.iter("Hit") for p in h.iter("Hsp")]
    assert got == [(r[0], f"{r[1][:-1]} A & B", int(r[-1]), r[-1]) for r in rows]
    sinks.write_report(numbered_rows.limit(0), str(tmp_path / "7.xml"), "blastp")
    assert [*ElementTree.parse(tmp_path / "7.xml").getroot().iter("Iteration")] == [] and {p.name for p in tmp_path.iterdir() if p.name[0] != "."} == {"1.xml", "7.xml"}
