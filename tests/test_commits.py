"""Snapshots, commits that fail, folded history, rejects, and kept results that are trusted by their listing."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from palimpsest import commits
from palimpsest.commits import CommitConflict, Log
from palimpsest.sources.formats import Format
from palimpsest.store import BelowFloor, Store


def release(spark, entries):
    return spark.createDataFrame([(k, {"ID": f">{k}", "SEQ": s}) for k, s in entries.items()], "entry_key string, fields map<string,string>")


def texts(rows):
    return sorted(r.text for r in rows.collect())


def test_a_read_keeps_its_commit(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "CHECKPOINT_EVERY", 2)
    store = Store(spark, str(tmp_path))
    store.put(release(spark, {"a": "A", "b": "C"}), "c", 1)
    store.put(release(spark, {"a": "G", "b": "C"}), "c", 2)
    before = store.get("c", start=1)
    store.put(release(spark, {"z": "T"}), "c", 2)  # the same version again
    store.put(release(spark, {"a": "A"}), "c", 3)
    store.compact("c", 3)
    assert texts(before.existing) == [">a\nG", ">b\nC"] and before.metadata.first().full_entries == 2
    assert texts(store.get("c", start=1).existing) == [">a\nA"]
    assert texts(store.get("c", start=1, commit=2).existing) == [">a\nG", ">b\nC"]
    fresh = Store(spark, str(tmp_path))  # from the log's checkpoint
    assert fresh.snapshot() == store.snapshot() and fresh.versions("c") == [1, 2, 3] and fresh.table("versions").count() == 4
    assert fresh.vacuum(older_than_hours=1) == 0
    time.sleep(1)
    assert fresh.vacuum(older_than_hours=0) > 2
    assert texts(store.get("c", start=1).existing) == [">a\nA"]
    with pytest.raises(ValueError):
        store.snapshot(99)


def test_a_put_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    store.put(release(spark, {"a": "A"}), "c", 1)
    seen, real = store.snapshot(), Store._written

    def dies(self, name, *rest, **options):
        if name == "presence":
            raise RuntimeError("killed between tables")
        return real(self, name, *rest, **options)

    monkeypatch.setattr(Store, "_written", dies)
    for version in (1, 2):
        with pytest.raises(RuntimeError):
            store.put(release(spark, {"b": "C"}), "c", version)
    monkeypatch.undo()
    assert store.snapshot() == seen and texts(store.get("c", start=1).existing) == [">a\nA"]
    store.put(release(spark, {"b": "C"}), "c", 1)
    assert texts(store.get("c", start=1).existing) == [">b\nC"]


def test_of_two_puts_at_once_one_fails(spark, tmp_path, monkeypatch):
    store, other, real = Store(spark, str(tmp_path)), Store(spark, str(tmp_path)), Log.commit
    store.put(release(spark, {"a": "A"}), "c", 1)
    rivals = {"c": lambda: other.put(release(spark, {"r": "R"}), "c", 2), "d": lambda: other.put(release(spark, {"r": "R"}), "d", 1)}
    for name, rival in rivals.items():

        def late(self, base, actions, rival=rival):
            monkeypatch.setattr(Log, "commit", real)
            rival()
            return real(self, base, actions)

        monkeypatch.setattr(Log, "commit", late)
        if name == "c":
            with pytest.raises(CommitConflict):
                store.put(release(spark, {"m": "M"}), "c", 2)
            assert texts(store.get("c", start=1).existing) == [">r\nR"]
        else:  # another collection: both count
            store.put(release(spark, {"m": "M"}), "c", 3)
            assert texts(store.get("c", start=1).existing) == [">m\nM"] and texts(store.get("d").existing) == [">r\nR"]
    left = {p.name for p in (tmp_path / "presence").iterdir()}
    assert left == {Path(f).relative_to(tmp_path / "presence").parts[0] for (t, *_), f in store.snapshot().slices.items() if t == "presence"}


def test_folded_history_is_refused(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for v, entries in ((1, {"a": "A"}), (2, {"a": "A", "b": "C"}), (3, {"a": "G", "b": "C"})):
        store.put(release(spark, entries), "c", v)
        if v == 1:
            store.export("c", run_id="7")
    store.compact("c", 2)
    for options in ({"start": 1, "stop": 1}, {"run_id": "7"}, {"start": 2, "stop": 2}):
        with pytest.raises(BelowFloor):
            store.get("c", **options)
    assert texts(store.get("c", run_id="7", full_run=True).existing) == [">a\nG", ">b\nC"]
    assert texts(store.get("c", start=3).existing) == [">a\nG"] and texts(store.get("c", start=1, stop=2).existing) == [">a\nA", ">b\nC"]
    with pytest.raises(ValueError):
        store.compact("c", 9)


def test_kept_results_are_trusted_by_listing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.put(release(spark, {k: "ACGT" for k in "abcdef"}), "c", 1)
    result, kept = store.export("c", f"{tmp_path}/out", split=3)
    assert result.metadata.first().inc_entries == 6
    row = store.table("materializations").where(F.col("path") == kept).first()
    parts = sorted(Path(kept).glob("part-*"))
    assert row.rows == 6 and [(p.name, p.stat().st_size) for p in parts] == [tuple(p) for p in row.parts]
    content = parts[0].read_bytes()
    parts[0].write_bytes(bytes(len(content)))  # nothing opens it
    assert store.export("c", f"{tmp_path}/out", split=3)[1] == kept and store.table("materializations").count() == 2
    parts[0].write_bytes(content[:-1])
    redone = store.export("c", f"{tmp_path}/out", split=3)[1]
    assert redone != kept and texts(spark.read.parquet(redone)) == [f">{k}\nACGT" for k in "abcdef"]
    next(Path(f"{tmp_path}/out").glob("part-*")).unlink()
    store.export("c", f"{tmp_path}/out", split=3)
    assert len(spark.read.text(f"{tmp_path}/out").collect()) == 12 and store.table("materializations").count() == 4


def test_rejects_are_kept(spark, tmp_path):
    files = tmp_path / "in"
    files.mkdir()
    (files / "x.tab").write_text("\t".join("qs" + "1" * 10) + "\ntoo\tshort\n\n")
    (files / "y.tab").write_text("alone\n")
    store = Store(spark, str(tmp_path / "store"))
    assert store.put(str(files), "hits", 1, "blastoutput") == {"n_entries": 1, "n_new": 1, "n_modified": 0, "n_deleted": 0, "n_rejected": 2}
    bad = [(r.file.rsplit("/", 1)[1], r.block, r.reason, r.record, r.version) for r in store.table("rejects").orderBy("file").collect()]
    assert bad == [("x.tab", 0, "not a record of the format", "too\tshort", 1), ("y.tab", 0, "not a record of the format", "alone", 1)]
    (files / "y.tab").unlink()
    assert store.put(str(files), "hits", 1, "blastoutput")["n_rejected"] == 1 and store.table("rejects").count() == 1


def test_a_format_of_ones_own_with_patterns(spark, tmp_path):
    own = Format("steps", "\n", lambda r: F.create_map(F.lit("ID"), F.substring_index(r, "\n", 1), F.lit("BODY"), r), {"TEXT": lambda f, a: F.element_at(f, F.lit("BODY"))}, default_type="TEXT", bounds=(r"step \d+", "end"))
    (tmp_path / "s.txt").write_text("preamble\r\nstep 1\r\nfirst\r\nstep 22\nsecond\nend\nloose\nstep 3\n")
    store = Store(spark, str(tmp_path / "store"), {"steps": own})
    store.put(str(tmp_path / "s.txt"), "s", 1, "steps")
    assert texts(Store(spark, str(tmp_path / "store"), {"steps": own}).get("s").existing) == ["step 1\nfirst", "step 22\nsecond", "step 3"]


def test_empty_releases(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.fa").write_text("; only a comment\n")
    for version, entries in ((1, {}), (2, {"a": "A"}), (3, {})):
        store.put(release(spark, entries), "c", version)
    assert store.put(str(tmp_path / "in"), "c", 4)["n_entries"] == 0
    assert texts(store.get("c", start=1, stop=2).existing) == [">a\nA"] and texts(store.get("c", start=1).existing) == []
    result, kept = store.export("c", f"{tmp_path}/out", start=1)
    assert result.metadata.first().inc_entries == 0 and store.export("c", start=1)[1] == kept and spark.read.text(f"{tmp_path}/out").count() == 0
