"""Puts and gets: property tests over release sequences, and the tutorial's scenario."""

import hashlib
import random
import shutil
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from palimpsest.operators import asof, manifest
from palimpsest.sources import files
from palimpsest.store import Store
from palimpsest.streaming.ingest import ingest


def release(spark, entries):
    return spark.createDataFrame([*entries.items()], "entry_key string, fields map<string,string>")


def state(store, collection, version):
    cells, seen = (store.table(t).where((F.col("collection") == collection) & F.col("entry_key").isNotNull()) for t in ("cells", "presence"))
    return {r.entry_key: r.fields for r in asof.incremental(cells, seen, None, version, (), complete=True).collect()}


def delta(store, collection, start, stop):
    got = store.get(collection, start=start, stop=stop)
    return {r.entry_key for r in got.existing.collect()}, {r.entry_key for r in got.deleted.collect()}, got.metadata.first()


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_gives_each_release_again(spark, tmp_path, seed):
    rng = random.Random(seed)
    make = lambda: {k: {f: rng.choice("ab") for f in ("ID", "SEQ", "X") if f == "ID" or rng.random() < 0.7} for k in "pqrs" if rng.random() < 0.7}
    releases = {v: make() for v in (1, 2, 3)}
    order = rng.sample([1, 2, 3], 3)
    store = Store(spark, str(tmp_path))
    for v in order:
        store.put(release(spark, releases[v]), "c", v)
    releases[order[0]] = make()  # a version put again
    store.put(release(spark, releases[order[0]]), "c", order[0])
    for v in releases:
        assert state(store, "c", v) == releases[v]
    for a, b in ((1, 2), (1, 3), (2, 3)):  # asof(a) + delta - deleted = asof(b), for the fields that count
        changed, deleted, meta = delta(store, "c", a + 1, b)
        count = lambda v: {k: (f.get("ID"), f.get("SEQ")) for k, f in releases[v].items()}
        merged = {k: x for k, x in count(a).items() if k in releases[b]} | {k: count(b)[k] for k in changed}
        assert {k: merged.get(k) for k in releases[b] if k in releases[a] or k in changed} == {k: count(b)[k] for k in releases[b] if k in releases[a] or k in changed}
        assert meta.inc_entries == len(changed) and meta.full_entries == len(releases[b]) and meta.deleted_entries == len(deleted)
        assert deleted == {k for v in range(a + 1, b) for k in releases[v]} - set(releases[b])


def test_runs_windows_and_reuse(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.put(release(spark, {"a_sapiens": {"ID": ">a Homo sapiens", "SEQ": "AC GT"}, "b": {"ID": ">b Mus", "SEQ": "T"}}), "sprot", 201501)
    first, path = store.export("sprot", run_id="1", regex="ID=.*SAPIENS.*", path=f"{tmp_path}/out")
    assert [r.text for r in first.existing.collect()] == [">a Homo sapiens\nACGT"]
    assert store.get("sprot", run_id="1").status == "unchanged"
    assert store.get("sprot", run_id="10").start == 1  # run 10 is not run 1
    store.put(release(spark, {"a_sapiens": {"ID": ">a Homo sapiens", "SEQ": "ACGA"}, "b": {"ID": ">b Mus", "SEQ": "T"}}), "sprot", 201503)
    second = store.get("sprot", run_id="1")
    assert (second.start, second.stop, second.status) == (201502, 201503, "new")
    assert [r.entry_key for r in second.existing.collect()] == ["a_sapiens"]
    assert store.get("sprot", stop=201502).stop == 201501  # between two versions
    assert store.get("sprot", run_id="1", full_run=True).start == 1
    again, same = store.export("sprot", run_id="2", start=1, stop=201501, regex="ID=.*SAPIENS.*", path=f"{tmp_path}/out")
    assert same == path and store.table("materializations").count() == 2
    assert store.lineage("1").first().version == 201501
    window = store.get("sprot", start=201503, regex={"ID": ".*"}, predicate_scope="window")
    assert window.existing.count() == 0  # ID did not change in the window
    store.compact("sprot", 201503)
    assert state(store, "sprot", 201503)["a_sapiens"]["SEQ"] == "ACGA"
    with pytest.raises(ValueError):
        store.drop()
    store.drop(confirm=True)
    assert store.table("cells").count() == 0


def test_export_follows_what_was_put(spark, tmp_path):
    store, out = Store(spark, str(tmp_path / "store")), f"{tmp_path}/out"
    entry = lambda k, seq: {k: {"ID": f">{k}", "SEQ": seq}}

    def exported(**options):
        folder = store.export("c", start=1, stop=3, path=out, **options)[1]
        kept = sorted(r.text for r in spark.read.parquet(folder).collect())
        lines = sorted("\n".join(r.value for r in spark.read.text(out).collect()).split("\n"))
        assert lines == sorted("\n".join(kept).split("\n"))
        return kept, folder

    store.put(release(spark, entry("a", "A")), "c", 3)
    first, folder = exported()
    assert first == [">a\nA"] and exported()[1] == folder
    store.put(release(spark, entry("b", "C")), "c", 3, mode="union")  # a further part of the release
    assert exported()[0] == [">a\nA", ">b\nC"]
    store.put(release(spark, entry("a", "A")), "c", 3)  # put again
    again, folder = exported()
    assert again == first
    store.put(release(spark, entry("a", "A")), "c", 2)  # back-fill
    assert exported()[1] != folder
    pair = [store.export("c", start=3, stop=3, regex={"ID": ".*"}, predicate_scope=scope)[1] for scope in ("state", "window")]
    assert pair[0] != pair[1]
    for gone in ("whole", "part"):
        folder = exported()[1]
        if gone == "whole":
            shutil.rmtree(folder)
        else:
            [f.unlink() for f in Path(folder).glob("*part-*")]
        redone, other = exported()
        assert redone == first and other != folder


def test_scopes_are_apart(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for run, seq in (("1", "A"), ("10", "C")):
        store.put(release(spark, {"x": {"ID": ">x", "SEQ": seq}}), "own", 1, run_id=run, task_id=2)
    got = store.get("own", run_id="1", task_id=2, start=1)
    assert [(r.text, r.task_id) for r in got.existing.collect()] == [(">x\nA", "0002")]
    assert store.latest_version("own", "1", "0002") == 1 and store.latest_version("own", "7", "0000") == 1


def test_dropped_releases_are_puts(spark, tmp_path, monkeypatch):
    texts = {1: ["; a comment\r\n>a one\r\nAC\r\nGT\r\n>b\r\nTT", ">d\nA"], 2: [">a one\nACGT\n>c\nG\n>no"], 3: [">z\nA"]}
    for v, parts in texts.items():
        (tmp_path / f"in/version={v}").mkdir(parents=True)
        for k, text in enumerate(parts):
            (tmp_path / f"in/version={v}/r{k}.fa").write_text(text, newline="")
        (tmp_path / f"in/version={v}/{len(parts) + (v == 3)}.done").write_text("closed")
    store, other = Store(spark, str(tmp_path / "store")), Store(spark, str(tmp_path / "other"))
    run = lambda: ingest(store, str(tmp_path / "in"), "drop", "fasta", str(tmp_path / "ckpt")).awaitTermination()
    real = Store.put

    def killed(self, release, collection, version, *rest, **options):
        out = real(self, release, collection, version, *rest, **options)
        if version == 1:
            raise RuntimeError("killed after its commit")
        return out

    monkeypatch.setattr(Store, "put", killed)
    with pytest.raises(Exception, match="killed"):
        run()
    monkeypatch.setattr(Store, "put", real)
    for _ in range(2):
        run()
    for v in (1, 2):
        other.put(str(tmp_path / f"in/version={v}"), "drop", v)
        assert state(store, "drop", v) == state(other, "drop", v)
    assert state(store, "drop", 1) == {">a one": {"ID": ">a one", "SEQ": "ACGT"}, ">b": {"ID": ">b", "SEQ": "TT"}, ">d": {"ID": ">d", "SEQ": "A"}}
    registered = [(r.version, r.entries) for r in store.table("versions").orderBy("version").collect()]
    assert registered == [(1, 3), (2, 3)]  # one row a release; the third waits for its second part
    assert {r.entry_key for r in store.get("drop", start=1, stop=2).deleted.collect()} == {">b", ">d"}
    (tmp_path / "in/version=3/r1.fa").write_text(">y\nC")
    run()
    assert store.versions("drop") == [1, 2, 3] and set(state(store, "drop", 3)) == {">z", ">y"}


def test_raw_files(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "a.txt").write_text("one")
    (folder / "b.txt").write_text("two")
    store = Store(spark, str(tmp_path / "store"))
    assert store.put_raw(str(folder), "raw", 1) == 2
    (folder / "a.txt").write_text("changed")
    (folder / "b.txt").unlink()
    assert store.put_raw(str(folder), "raw", 2) == 1
    now = {r.path.rsplit("/", 1)[1]: (r.size, r.version, r.is_deleted) for r in store.files("raw").collect()}
    assert now == {"a.txt": (7, 2, False), "b.txt": (3, 1, True)}
    assert store.files("raw", 1).where("is_deleted").count() == 0
    (folder / "sub").mkdir()
    (folder / "sub/a.txt").write_text("inner")
    store.put_raw(str(folder), "work/set", 1)
    store.put_raw(str(folder / "sub"), "work/set/sub", 1)
    found = lambda path: [(r.path.split("/raw/")[1], r.size) for r in store.get_file(path).collect()]
    assert found("work/set/a.txt") == [("a.txt", 7)] and found("work/set/sub/a.txt") == [("sub/a.txt", 5)]
    assert found("work/set/b.txt") == found("work/else/a.txt") == found("none") == []


def test_a_path_is_asked_of_the_scans(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for k in range(40):
        (folder / f"f{k:02d} é.txt").write_text(str(k))
    (folder / "empty.txt").write_text("")
    store = Store(spark, str(tmp_path / "store"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)  # else so few rows are one file
    try:
        assert store.put_raw(str(folder), "tree", 1) == 41
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.size for r in store.get_file("tree/empty.txt").collect()] == [0]
    one = store.get_file("tree/f17 é.txt")
    assert [(r.size, r.below) for r in one.collect()] == [(2, "f17 é.txt")]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(entry_key,f17 é.txt)") >= 2
    bounds = [pq.read_metadata(p).row_group(0).column(2).statistics for p in (tmp_path / "store/cells").rglob("*.parquet")]
    assert len(bounds) > 1 and sum(b.min <= "f17 é.txt" <= b.max for b in bounds) == 1  # the key lies in one file


def test_files_of_any_size(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with open(tmp_path / "in/large.bin", "wb") as out:
        out.truncate((1 << 31) + 5)  # more than a row can hold
        out.seek(1 << 30)
        out.write(b"middle")
    (tmp_path / "in/small.bin").write_bytes(b"x")
    digest = hashlib.sha256()
    with open(tmp_path / "in/large.bin", "rb") as stream:
        while block := stream.read(1 << 24):
            digest.update(block)
    found = manifest.from_folder(spark, str(tmp_path / "in"), 1)
    wanted = found.select(F.element_at(F.split("path", "/"), -1).alias("path"))
    copied = {r.path: (r.size, r.hash) for r in files.copy_files(wanted, str(tmp_path / "in"), str(tmp_path / "out")).collect()}
    (tmp_path / "out/large.bin").unlink()
    assert copied == {"large.bin": ((1 << 31) + 5, digest.hexdigest()), "small.bin": (1, hashlib.sha256(b"x").hexdigest())}
