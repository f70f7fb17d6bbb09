"""The versioned store: releases are put, changes are kept, versions and increments are got.

Entries lie in Parquet folders, one per commit, table and slice (collection, scope, version); a scope is
``_`` for shared collections and ``run_task`` for run-scoped ones. A put writes new folders and then makes
one commit, which names the slices that count from then on and registers the version. So a put that dies
before its commit changes nothing, and of two that change one collection at once the later fails. A read
holds the files of the commit it began with: puts and compactions made since do not disturb it, until
:meth:`Store.vacuum` removes what no kept commit names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .commits import CommitConflict, Files, Log, Snapshot
from .functions.text import cache_key, path_suffix
from .operators import asof, counts, diff, filters, lineage, manifest
from .sources import sinks
from .sources.files import listed, measured
from .sources.formats import FORMATS, Format

KEYS = ("run_id", "task_id", "entry_key")
#: Tables of slices, and registers, which are rows of the log.
SLICED = {
    "cells": "run_id string, task_id string, entry_key string, cells array<struct<field:string,value:string>>, present boolean, collection string, scope string, version long",
    "presence": "run_id string, task_id string, entry_key string, collection string, scope string, version long",
    "rejects": "file string, block long, reason string, record string, collection string, scope string, version long",
}
REGISTERS = {
    "versions": "collection string, run_id string, task_id string, version long, ingested_at timestamp, entries long",
    "collections": "collection string, format string, is_database boolean",
    "runs": "run_id string, collection string, direction string, version long, path string, regex string, recorded_at timestamp",
    "materializations": "collection string, cache_key string, path string, digest string, created_at timestamp, rows long, parts array<struct<name:string,length:long>>",
}
SCHEMAS = SLICED | REGISTERS
#: Cells as :meth:`Store.table` gives them, a row each; they are stored by entry, with whether its release had it.
CELLS = "run_id string, task_id string, entry_key string, field string, value string, is_tombstone boolean, collection string, scope string, version long"
_KINDS = {"versions": "version", "collections": "collection", "runs": "run", "materializations": "materialization"}


class BelowFloor(ValueError):
    """What was asked for lies in history that a compaction folded."""


@dataclass
class GetResult:
    """``existing`` (keys, fields, text), ``deleted`` keys and a ``metadata`` row, all lazy, as of ``commit``."""

    status: str
    start: int
    stop: int | None
    existing: DataFrame
    deleted: DataFrame
    metadata: DataFrame
    commit: int
    #: The metadata row for a known number of existing entries, without working them out again.
    counted: Callable[[int], DataFrame]


def _now() -> int:
    """Microseconds since 1970, in UTC."""
    return int(datetime.now(timezone.utc).timestamp() * 1_000_000)


class Store:
    def __init__(self, spark: SparkSession, root: str, formats: Mapping[str, Format] | None = None, **tables: str):
        """``formats`` are further formats by name; ``tables`` renames tables of slices, by keyword."""
        self.spark, self.root = spark, root.rstrip("/")
        self.formats = {**FORMATS, **(formats or {})}
        self.names = {name: tables.get(name, name) for name in SLICED}
        self.files_at, self.log = Files(spark), Log(spark, f"{self.root}/log")
        self._staged: list[str] = []

    # tables

    def _path(self, table: str) -> str:
        return f"{self.root}/{self.names[table]}"

    def snapshot(self, commit: int | None = None) -> Snapshot:
        """The store as of a commit; by default the last."""
        return self.log.snapshot(commit)

    def table(self, name: str, at: Snapshot | None = None, collection: str | None = None, versions: Callable[[int], bool] = lambda v: True) -> DataFrame:
        """A table of the store as of a commit, of one collection if given; its files are fixed by the call."""
        at = at or self.snapshot()
        columns = [c.split()[0] for c in SCHEMAS[name].split(", ")]
        if name in REGISTERS:
            times = {"ingested_at", "recorded_at", "created_at"}
            rows = self.log.frame(at.number).where(F.col("action") == _KINDS[name])
            rows = rows.select(*[F.timestamp_micros("at").alias(c) if c in times else F.col(c) for c in columns])
            return rows if collection is None else rows.where(F.col("collection") == collection)
        rows = self._stored(name, at, collection, versions)
        if name != "cells":
            return rows
        rows = rows.select("*", F.explode("cells").alias("c")).select("*", "c.field", "c.value", F.col("c.value").isNull().alias("is_tombstone"))
        return rows.select(*[c.split()[0] for c in CELLS.split(", ")])

    def _folders(self, name: str, at: Snapshot, collection: str | None, versions: Callable[[int], bool], scope: str | None = None) -> list[str]:
        return [f for (t, c, s, v), f in at.slices.items() if t == name and f and collection in (None, c) and scope in (None, s) and versions(v)]

    def _stored(self, name: str, at: Snapshot, collection: str | None = None, versions: Callable[[int], bool] = lambda v: True, scope: str | None = None) -> DataFrame:
        """Slices as they are stored; where there are none, rows that the optimizer knows to be none."""
        return self._read(name, self._folders(name, at, collection, versions, scope))

    def _read(self, name: str, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], SLICED[name]).limit(0)
        return self.spark.read.schema(SLICED[name]).option("basePath", self._path(name)).parquet(*folders).select(*[c.split()[0] for c in SLICED[name].split(", ")])

    def _aside(self, rows: DataFrame) -> DataFrame:
        """``rows`` written beside the tables and read again: once worked out."""
        folder = f"{self.root}/_staged/{uuid.uuid4()}"
        rows.write.option("compression", "zstd").parquet(folder)
        self._staged.append(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def _tidy(self) -> None:
        while self._staged:
            self.files_at.delete(self._staged.pop())

    def _written(self, name: str, rows: DataFrame, slices: list[tuple[str, str, int]], cluster: bool = False, keep: str | None = None, **measures: Column) -> list[dict]:
        """Write rows of ``slices`` (collection, scope, version) to a new folder, if asked for in ranges of keys; the actions that make them count.

        ``measures`` are aggregated on the way, into ``measured``; rows that are not to ``keep`` are measured, and not written."""
        if cluster:
            rows = rows.repartitionByRange("entry_key").sortWithinPartitions("entry_key")
        folder, seen = f"{self._path(name)}/commit=c-{uuid.uuid4()}", Observation()
        if measures:
            rows = rows.observe(seen, *[c.alias(n) for n, c in measures.items()])
        rows = rows if keep is None else rows.where(keep)
        rows.select(*[f.split()[0] for f in SLICED[name].split(", ")]).write.option("compression", "zstd").partitionBy("collection", "scope", "version").parquet(folder)
        self.measured = {n: v or 0 for n, v in seen.get.items()} if measures else {}
        found = {(c, s, int(v)): at for (c, s, v), at in self.files_at.leaves(folder, 3).items()}
        return [{"action": "slice", "table": name, "collection": c, "scope": s, "version": v, "folder": found.get((c, s, v))} for c, s, v in slices]

    # registry

    def collection(self, name: str) -> tuple[Format, bool]:
        """Format of a collection, and whether it is shared by all runs."""
        known = self.snapshot().collections
        if name not in known:
            raise KeyError(f"no collection {name!r}")
        return self.formats[known[name][0]], known[name][1]

    def versions(self, collection: str, run_id: str | None = None, task_id: str | None = None, at: Snapshot | None = None) -> list[int]:
        """Registered versions, of a run and task if given, in order."""
        rows = (at or self.snapshot()).versions
        return sorted({v for c, r, t, v, _ in rows if c == collection and (run_id is None or (r == run_id and t == task_id))})

    def latest_version(self, collection: str, run_id: str | None = None, task_id: str | None = None) -> int | None:
        request = self.spark.createDataFrame([(collection, run_id, task_id)], "collection string, run_id string, task_id string")
        return lineage.latest_versions(request, self.table("versions")).first().version

    # put

    def put(self, release: DataFrame | str, collection: str, version: int, format: str | Format = "fasta", run_id: str | None = None, task_id: int | None = None,
            mode: str = "replace", ledger: str | None = None, cluster: bool = False) -> dict[str, int]:
        """Store a release under a version, and return its counters.

        ``release`` is (entry_key, fields), or a path read by the format; records of a path that the
        format rejects go to the table ``rejects`` with their file, split and reason. Any order of versions
        gives the same reads: the next version's slice is compared again, as its changes were
        relative to what this put replaces. ``mode="union"`` keeps entries that only an earlier
        put of this version had. A ``ledger`` key makes the put happen once: a later one with the same
        key gives no counters and changes nothing. ``cluster`` deals the slices to files by ranges of keys,
        for one more shuffle of what changed; :meth:`compact` always does.
        """
        if isinstance(format, Format):
            self.formats[format.name] = format
            format = format.name
        base = self.snapshot()
        if ledger is not None and ledger in base.ledger:
            return {}
        kind, (run, task, scope) = self.formats[format], self._scope(run_id, task_id)
        slice_ = (collection, scope, version)
        own = lambda versions: self._stored("cells", base, collection, versions, scope)
        seen = lambda versions: self._stored("presence", base, collection, versions, scope)
        one = lambda versions: len(self._folders("cells", base, collection, versions, scope)) < 2
        rejected: dict[str, int] = {"n_rejected": 0}
        actions: list[dict] = []
        if isinstance(release, str):
            judged = kind.judged(kind.records(self.spark, release))
            bad = judged.where("reason IS NOT NULL").select("file", "block", "reason", "record", *self._place(*slice_), F.lit(True).alias("fresh"))
            if mode == "union":
                bad = bad.unionByName(self._stored("rejects", base, collection, lambda v: v == version, scope).withColumn("fresh", F.lit(False)))
            actions += self._written("rejects", bad, [slice_], n_rejected=F.count_if("fresh"))
            rejected = self.measured
            release = kind.chosen(judged.where("reason IS NULL"))
        elif mode != "union":
            actions.append({"action": "slice", "table": "rejects", "collection": collection, "scope": scope, "version": version, "folder": None})
        release = release.select("entry_key", "fields")
        known = self.versions(collection, run, task, base)
        after = min((v for v in known if v > version), default=None)
        until, below = lambda v: v <= version, lambda v: v < version
        if mode == "union":
            release = self._aside(release)  # read more than once
            earlier = seen(lambda v: v == version).select("entry_key").join(release, "entry_key", "left_anti")
            release = release.unionByName(asof.merged(own(until).join(earlier, "entry_key", "left_semi"), once=one(until)).select("entry_key", "fields"))
        before = asof.merged(asof.signed(own(below)), once=one(below))
        last = max((v for v in known if v < version), default=-1)
        here = asof.present_at(seen(lambda v: v == last), last)
        keyed = [F.lit(run).alias("run_id"), F.lit(task).alias("task_id"), "entry_key"]
        changes = diff.changes(before, release, here, asof.signature)
        rows = changes.select(*keyed, "cells", "change", (F.col("change") != "removed").alias("present"), *self._place(*slice_))
        written = self._written("cells", rows, [slice_], cluster, "present", **counts.change_counters())
        found = self.measured
        actions += written
        fresh = self._read("cells", [a["folder"] for a in written if a["folder"]])
        if after is not None:
            history = own(lambda v: v <= after).withColumn("fresh", F.lit(False)).unionByName(asof.signed(fresh).withColumn("fresh", F.lit(True)))
            again = asof.compared_again(history, version, after).select(*keyed, "cells", "present", *self._place(collection, scope, after))
            actions += self._written("cells", again, [(collection, scope, after)], cluster)
        actions += self._written("presence", fresh.select(*keyed, *self._place(*slice_)), [slice_], cluster)
        if collection not in base.collections:
            actions.append({"action": "collection", "collection": collection, "format": format, "is_database": run == ""})
        actions.append({"action": "version", "collection": collection, "run_id": run, "task_id": task, "version": version, "at": _now(), "entries": found["n_entries"]})
        actions.append({"action": "run", "run_id": run, "collection": collection, "direction": "put", "version": version, "at": _now()})
        if ledger is not None:
            actions.append({"action": "ledger", "path": ledger})
        self._commit(base, actions)
        return found | rejected

    def _commit(self, base: Snapshot, actions: list[dict]) -> Snapshot:
        """One commit; what was staged goes, and so do the new folders where it fails."""
        try:
            return self.log.commit(base, actions)
        except CommitConflict:
            for folder in {a["folder"].split("/collection=")[0] for a in actions if a["action"] == "slice" and a["folder"]}:
                self.files_at.delete(folder)
            raise
        finally:
            self._tidy()

    @staticmethod
    def _scope(run_id: str | None, task_id: int | None) -> tuple[str, str, str]:
        """Run, four-digit task, and scope; empty and ``_`` for a shared collection."""
        run, task = run_id or "", "" if task_id is None else f"{task_id:04d}"
        return run, task, f"{run}_{task}" if run else "_"

    @staticmethod
    def _place(collection: str, scope: str, version: int) -> list:
        return [F.lit(collection).alias("collection"), F.lit(scope).alias("scope"), F.lit(version).cast("long").alias("version")]

    def put_raw(self, path: str, collection: str, version: int) -> int:
        """Keep the files below ``path`` unparsed under a version, and return how many there are.

        They are entries of a file collection under their path from ``path`` on; path, size and hash are
        their fields, so later versions store only what changed.
        """
        found = self._aside(measured(listed(self.spark, path)))  # ranges of keys are sampled: files are read once
        fields = F.create_map(F.lit("ID"), F.col("path"), F.lit("PATH"), F.col("path"), F.lit("HASH"), F.col("hash"), F.lit("SIZE"), F.col("size").cast("string"), F.lit("SUFFIX"), path_suffix(F.col("path")),
                              F.lit("BELOW"), F.col("below"))
        return self.put(found.select(F.col("below").alias("entry_key"), fields.alias("fields")), collection, version, "fullfile", cluster=True)["n_entries"]

    def files(self, collection: str, stop: int | None = None, below: str | None = None) -> DataFrame:
        """Manifest of a file collection as of a version: (path, size, hash, version, is_deleted, below).

        With ``below`` of the file of that path alone: the key goes to the scans, and as slices lie in
        ranges of keys, to the one file of each that may hold it.
        """
        now = self.snapshot()
        known = [v for v in self.versions(collection, at=now) if stop is None or v <= stop]
        at = known[-1] if known else -1
        cells, seen = (self._stored(t, now, collection, lambda v: v <= at) for t in ("cells", "presence"))
        if below is not None:
            cells, seen = (x.where(F.col("entry_key") == below) for x in (cells, seen))
        of = lambda name: F.element_at("fields", F.lit(name))
        here = asof.present_at(seen, at).withColumn("here", F.lit(True))
        rows = asof.merged(cells).join(here, "entry_key", "left")
        return rows.select(of("PATH").alias("path"), of("SIZE").cast("long").alias("size"), of("HASH").alias("hash"), F.element_at("versions", F.lit("HASH")).alias("version"), F.col("here").isNull().alias("is_deleted"), of("BELOW").alias("below"))

    def get_file(self, path: str, stop: int | None = None) -> DataFrame:
        """The live file at ``path``, as :meth:`files` has it: of the collection named by the nearest
        folder above it (or by the path itself), the file that lies there. No row if there is none."""
        asked = self.spark.createDataFrame([(path,)], "path string")
        folder = manifest.super_paths(asked, self.table("collections").select(F.col("collection").alias("path"))).first().super_path
        return manifest.live(self.files(folder if folder is not None else path, stop, path[len(folder or "") :].lstrip("/")))

    # get

    def get(self, collection: str, start: int | None = None, stop: int | None = None, run_id: str | None = None, task_id: int | None = None,
            regex: str | dict | None = None, kind: str | None = None, addendum: str = "", full_run: bool = False, predicate_scope: str = "state", commit: int | None = None) -> GetResult:
        """A collection as of ``stop`` with what changed since ``start``.

        ``stop`` is taken down to a registered version (default: the latest). Without ``start`` it
        is the version after the last that the run got, or 1; ``full_run`` begins at 1 whatever the
        run got. The filter sees entries as of ``stop``, or with ``predicate_scope="window"`` only
        fields that changed in the window. The result is of the store as of ``commit`` (default: the
        last one now) whenever it is read. A version below the floor that a compaction left, or a
        window that begins below it after some version, raises :class:`BelowFloor`.
        """
        fmt, shared = self.collection(collection)
        now = self.snapshot(commit)
        task = None if task_id is None else f"{task_id:04d}"
        mine = (None, None) if shared else (run_id, task)
        known = [v for v in self.versions(collection, *([None, None] if shared or run_id is None else [run_id, task or ""]), at=now) if stop is None or v <= stop]
        stop = known[-1] if known else None
        if start is None:
            start = 1
            if run_id is not None and not full_run:
                last = self.table("runs", now).where((F.col("run_id") == run_id) & (F.col("collection") == collection) & (F.col("direction") == "get"))
                start = (last.agg(F.max_by("version", "recorded_at").alias("v")).first().v or 0) + 1
        status = "unchanged" if stop is None or start > stop else "new"
        at = stop if status == "new" else -1
        if status == "new":
            self._above_floor(now, collection, None if shared or run_id is None else self._scope(run_id, task_id)[2], start, stop, known)
        in_time = lambda v: v <= at
        cells, seen = self._stored("cells", now, collection, in_time), self._stored("presence", now, collection, in_time)
        cells, seen = (filters.in_scope(x, mine[0], task_id if mine[1] else None) for x in (cells, seen))
        required = fmt.required.get(kind or fmt.default_type, ())
        whole = not fmt.incremental or not required
        once = [(c, v) for (t, c, _, v), f in now.slices.items() if t == "cells" and f and c == collection and v <= at] == [(collection, at)]
        entries = asof.incremental_merged(cells, seen, start, at, required, whole, KEYS, once)
        patterns = filters.parse_filter(regex)
        if patterns and predicate_scope == "window":
            window = asof.merged(asof.in_window(cells, start, at), KEYS).where(filters.matches(patterns, F.col("fields"))).select(*KEYS)
            entries = entries.join(window, [*KEYS], "left_semi")
        elif patterns:
            entries = entries.where(filters.matches(patterns, F.col("fields")))
        rendered = fmt.rendered(entries, kind, addendum)
        once = shared and not any(c == collection and r for c, r, *_ in now.versions)
        existing = rendered if once else sinks.first_per_key(rendered)  # without run-scoped puts a key is there once
        deleted = asof.deleted_in_window(seen, start, at, KEYS).select("entry_key").distinct()
        about = (seen, start, at, collection, kind or fmt.default_type, addendum)
        return GetResult(status, start, stop, existing, deleted, counts.get_metadata(existing, *about), now.number, lambda n: counts.get_metadata(n, *about, spark=self.spark))

    @staticmethod
    def _above_floor(now: Snapshot, collection: str, scope: str | None, start: int, stop: int, known: list[int]) -> None:
        floor = max((v for (c, s), v in now.floors.items() if c == collection and scope in (None, s)), default=None)
        if floor is None:
            return
        if stop < floor:
            raise BelowFloor(f"versions of {collection!r} before {floor} were folded; {stop} cannot be told apart")
        if start <= floor and any(v < start for v in known):
            raise BelowFloor(f"what changed in {collection!r} from {start} to {floor} was folded; get it whole with full_run=True, or from {floor + 1}")

    def export(self, collection: str, path: str | None = None, split: int = 1, copy: bool = True, **options) -> tuple[GetResult, str]:
        """Get, keep the rendered result for reuse, record the run, and write it to ``path``.

        The result is worked out once: its rows are counted and digested while they are written. An equal
        request is answered from the kept files, unless a version up to ``stop`` was put since, or the
        folder's listing differs from the names and lengths noted at writing; no data file is opened for
        that. A copy is not written again where the last one recorded for the path has its digest and its
        parts. ``copy=False`` writes nothing outside the store.
        """
        result = self.get(collection, **options)
        now, run = self.snapshot(result.commit), options.get("run_id")
        shared = now.collections[collection][1]
        addendum = "_".join([f"{options.get('kind') or ''}{options.get('addendum') or ''}", options.get("predicate_scope") or "state", self._stamp(now, collection, result.stop)])
        asked = self.spark.range(1).select(cache_key(
            *[F.lit(x) for x in (collection, result.start, result.stop, str(options.get("regex") or ""), addendum, split, run or "", str(options.get("task_id") or ""), shared)]).alias("k")).first().k
        done = self.table("materializations", now).where((F.col("cache_key") == asked) | (F.col("path") == F.lit(path)))
        done = sorted((r.asDict(recursive=True) for r in done.collect()), key=lambda r: r["created_at"])
        kept = next((r for r in reversed(done) if r["cache_key"] == asked), None)
        actions = []
        if kept is None or not self._whole(kept):
            folder, seen = f"{self.root}/results/{uuid.uuid4()}", Observation()
            rows = sinks.split_sorted(result.existing.select("entry_key", "text"), split).observe(seen, *[c.alias(n) for n, c in sinks.digest_columns().items()])
            rows.write.parquet(folder)
            kept = self._kept(collection, asked, folder, sinks.digest_text(seen.get), seen.get["n"])
            actions.append(kept)
        if copy and path is not None:
            there = next((r for r in reversed(done) if r["path"] == path), None)
            if there is None or there["digest"] != kept["digest"] or not self._whole(there):
                sinks.write_text(self.spark.read.parquet(kept["path"]), path)
                actions.append(self._kept(collection, f"{asked}:{path}", path, kept["digest"], kept["rows"]))
        actions.append({"action": "run", "run_id": run, "collection": collection, "direction": "get", "version": result.stop, "path": path or kept["path"], "regex": str(options.get("regex") or ""), "at": _now()})
        self._commit(now, actions)
        result.metadata = result.counted(kept["rows"])
        return result, kept["path"]

    def _kept(self, collection: str, key: str, folder: str, digest: str, rows: int) -> dict:
        parts = [{"name": n, "length": size} for n, size in self.files_at.parts(folder)]
        return {"action": "materialization", "collection": collection, "cache_key": key, "path": folder, "digest": digest, "rows": rows, "parts": parts, "at": _now()}

    @staticmethod
    def _stamp(now: Snapshot, collection: str, stop: int | None) -> str:
        """What registrations the state as of ``stop`` rests on: their number and the newest one's time.

        A put of any version up to ``stop``, again or as a back-fill, changes it.
        """
        times = [t for c, _, _, v, t in now.versions if c == collection and stop is not None and v <= stop]
        return f"{len(times)}_{max(times, default=0)}"

    def _whole(self, kept: dict) -> bool:
        """Whether a kept result's folder lists the parts noted when it was written."""
        return self.files_at.parts(kept["path"]) == [(p["name"], p["length"]) for p in kept["parts"]]

    # upkeep

    def lineage(self, run_id: str) -> DataFrame:
        return lineage.lineage_report(self.table("runs").where(F.col("run_id") == run_id))

    def compact(self, collection: str, version: int, run_id: str | None = None, task_id: int | None = None) -> None:
        """Turn the slices up to ``version`` into one snapshot at it: later reads scan less history,
        earlier versions can no longer be told apart, and asking for them raises :class:`BelowFloor`."""
        run, task, scope = self._scope(run_id, task_id)
        base = self.snapshot()
        if version not in self.versions(collection, run, task, base):
            raise ValueError(f"no version {version} of {collection!r}")
        # dealt by ranges once: the ranges of keys that the slice is written in are those it is merged in
        own = self._stored("cells", base, collection, lambda v: v <= version, scope).repartitionByRange("entry_key")
        newest = asof.merged(own, stop=version).select(F.lit(run).alias("run_id"), F.lit(task).alias("task_id"), "entry_key", asof.as_cells(F.col("fields")).alias("cells"), "present", *self._place(collection, scope, version))
        actions = self._written("cells", newest.sortWithinPartitions("entry_key"), [(collection, scope, version)])
        earlier = [v for (t, c, s, v) in base.slices if (t, c, s) == ("cells", collection, scope) and v < version]
        actions += [{"action": "slice", "table": "cells", "collection": collection, "scope": scope, "version": v, "folder": None} for v in earlier]
        actions.append({"action": "floor", "collection": collection, "scope": scope, "version": version})
        self._commit(base, actions)

    def vacuum(self, keep: int = 1, older_than_hours: float = 24 * 7) -> int:
        """Delete folders that none of the last ``keep`` commits names and that are older; return how many.

        Readers and writers that may still be at work must have begun later than that.
        """
        last = self.snapshot().number
        first = self.snapshot(max(0, last - keep + 1))
        named = {f for f in first.slices.values() if f} | {a["folder"] for n in range(first.number + 1, last + 1) for a in self.log.actions(n) if a.get("folder")}
        named |= {r.path for r in self.table("materializations").select("path").distinct().collect()}
        before, gone = _now() / 1000 - older_than_hours * 3_600_000, 0
        for folder in [*map(self._path, SLICED), f"{self.root}/_staged", f"{self.root}/results"]:
            for name, _, time, inner in self.files_at.listed(folder):
                if inner and time < before and not any(f == f"{folder}/{name}" or f.startswith(f"{folder}/{name}/") for f in named):
                    self.files_at.delete(f"{folder}/{name}")
                    gone += 1
        return gone

    def drop(self, confirm: bool = False) -> None:
        """Delete all tables of the store; refuses without ``confirm``."""
        if not confirm:
            raise ValueError("drop(confirm=True) deletes the store")
        for folder in [f"{self.root}/log", *map(self._path, SLICED), f"{self.root}/_staged", f"{self.root}/results"]:
            self.files_at.delete(folder)
        self.log = Log(self.spark, f"{self.root}/log")
