"""Plain files: sequence folders, search reports, key and value lists, and copies of managed files."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager, nullcontext
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..commits import Files
from ..functions.checkpoints import shared_folder
from ..operators.hits import HIT_SCHEMA, HSP_ELEMENTS


def read_sequence_lines(spark: SparkSession, folder: str, ending: str = "fna") -> DataFrame:
    """(file, value): lines of all files below ``folder`` whose name ends so."""
    lines = spark.read.option("pathGlobFilter", f"*{ending}").option("recursiveFileLookup", True).text(folder)
    return lines.select(F.col("_metadata.file_path").alias("file"), "value")


def concatenate_sequences(spark: SparkSession, folder: str, target: str, ending: str = "fna", single: bool = False) -> None:
    """All sequence files as one folder of text; if asked for as one file, which is joined from the parts."""
    parts = shared_folder(spark) if single else target
    read_sequence_lines(spark, folder, ending).select("value").write.mode("overwrite").text(parts)
    if single:
        at = Files(spark)
        join_parts(spark, [f"{parts}/{name}" for name, size in at.parts(parts) if size], target)
        at.delete(parts)


def _system(path: str) -> tuple[FileSystem, str]:
    """The file system of an address, and the path on it."""
    if path.startswith("file:"):
        return LocalFileSystem(), "/" + path[5:].lstrip("/")
    return FileSystem.from_uri(path) if "://" in path else (LocalFileSystem(), path)


def _joined_on_hdfs(spark: SparkSession, parts: list[str], target: str, draft: str, head: str, end: str) -> bool:
    """Join by HDFS's own concatenation; False on other file systems, or where it refuses."""
    files, path = Files(spark), spark._jvm.org.apache.hadoop.fs.Path
    system, at = files.of(target)
    if system.getUri().getScheme() != "hdfs" or not head:
        return False
    files.create(draft, head)
    every = [*parts, f"{draft}.end"]
    files.create(every[-1], end)
    names = spark.sparkContext._gateway.new_array(path, len(every))
    for k, part in enumerate(every):
        names[k] = path(part)
    try:
        system.concat(path(draft), names)
    except Exception:  # parts on another volume, or encrypted: they are copied instead
        files.delete(draft), files.delete(every[-1])
        return False
    system.delete(at, True)
    return system.rename(path(draft), at)


def join_parts(spark: SparkSession, parts: list[str], target: str, head: str = "", end: str = "") -> None:
    """One file of ``head``, the files ``parts`` in order, and ``end``. It appears whole, at the end.

    HDFS joins files without moving their data. Elsewhere one task copies them, a few megabytes at a time, and
    unpacks those whose name ends with ``.gz``.
    """
    draft = f"{target}.{uuid.uuid4().hex}.part"
    if _joined_on_hdfs(spark, parts, target, draft, head, end):
        return

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for b in batches if b.num_rows):
            to, place = _system(draft)
            to.create_dir(place.rsplit("/", 1)[0], recursive=True)
            with to.open_output_stream(place) as out:
                out.write(head.encode())
                for part in parts:
                    source, name = _system(part)
                    with source.open_input_stream(name, compression="gzip" if name.endswith(".gz") else None) as stream:
                        while block := stream.read(4 << 20):
                            out.write(block)
                out.write(end.encode())
            final = _system(target)[1]
            if to.get_file_info(final).type != FileType.NotFound:
                to.delete_file(final)
            to.move(place, final)
            yield batch

    spark.range(0, 1, 1, 1).mapInArrow(copy, "id long").collect()


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Tabular hits with file and line_no; rows without exactly twelve columns are dropped.

    line_no is ordered within a file: where the line's split begins, then the reading order in it.
    """
    fields = [f.strip().split(" ") for f in HIT_SCHEMA.split(",")]
    parts = F.split("value", "\t")
    place = F.struct(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), place.alias("line_no"))
    cells = [F.get(parts, F.lit(i)).try_cast(kind).alias(name) for i, (name, kind) in enumerate(fields)]
    return lines.where(F.size(parts) == len(fields)).select(*cells, "file", "line_no")


#: Bytes of a file that a task holds at once.
BLOCK = 4 << 20

#: Bytes of a report that a task reads on its own.
RANGE = 32 << 20

# The elements that a report's iterations, hits and HSPs have, their columns and types.
_ITERATION = {"iteration_no": ("Iteration_iter-num", "long"), "query_id": ("Iteration_query-def", "string"), "query_len": ("Iteration_query-len", "long")}
_HIT = {"hit_no": ("Hit_num", "long"), "hit_def": ("Hit_def", "string"), "hit_len": ("Hit_len", "long")}
_HSP = {column: (name, "double" if column in ("e_value", "hit") else "long") for name, column in HSP_ELEMENTS}
_TAGS = ["Iteration", "Hit", "Hsp", *[name for fields in (_ITERATION, _HIT, _HSP) for name, _ in fields.values()]]
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))


def _report_texts(path: str, begin: int, end: int) -> Iterator[bytes]:
    """What a report has from the first HSP at or after ``begin`` (0: from its head) to the first at or after ``end``, in texts of some megabytes that begin with an HSP."""
    system, place = _system(path)
    with system.open_input_file(place) as file:
        at, text, started = begin, b"", begin == 0
        while block := file.read_at(BLOCK, at):
            text, at = text + block, at + len(block)
            if not started:
                first = text.find(b"<Hsp>")
                text, started = (text[first:], True) if first >= 0 else (text[-4:], False)
                if at - len(text) >= end:
                    return
            if started:
                stop = text.find(b"<Hsp>", max(0, end - at + len(text)))
                if stop >= 0:
                    yield text[:stop]
                    return
                last = text.rfind(b"<Hsp>", 1)
                if last > 0:
                    yield text[:last]
                    text = text[last:]
        if started and text:
            yield text


def _opened(text: bytes, before: tuple[bytes, bytes]) -> tuple[bytes, bytes]:
    """The heads of the last iteration and the last hit of a text; those before where none begins in it."""
    iteration, hit = text.rfind(b"<Iteration>"), text.rfind(b"<Hit>")
    return (text[iteration:].split(b"<Hit>", 1)[0].split(b"<Hsp>", 1)[0] if iteration >= 0 else before[0],
            text[hit:].split(b"<Hsp>", 1)[0] if hit >= 0 else before[1])


def _parsed(values: pa.Array, kind: str) -> pa.Array:
    """Texts of elements as strings, their characters as they are, or as numbers, null where they are none."""
    if kind == "string":
        if pc.any(pc.match_substring(values, "&#")).as_py():
            return pa.array([v and unescape(v) for v in values.to_pylist()], pa.string())
        if pc.any(pc.match_substring(values, "&")).as_py():
            for entity, mark in _ENTITIES:
                values = pc.replace_substring(values, entity, mark)
        return values
    typed, read = (pa.int64(), int) if kind == "long" else (pa.float64(), float)
    try:
        return pc.if_else(pc.equal(values, ""), None, values).cast(typed)
    except pa.ArrowInvalid:

        def number(value: str | None) -> float | int | None:
            try:
                return None if value is None else read(value)
            except ValueError:
                return None

        return pa.array([number(v) for v in values.to_pylist()], typed)


def _hsps(text: bytes) -> pa.RecordBatch:
    """A row for each HSP in a text that has the heads of its hit and iteration before it."""
    if b"<![CDATA[" in text or b"<!--" in text:
        raise ValueError("a report with comments or CDATA sections is not read by ranges")
    opened = pc.split_pattern(pa.array([text], pa.binary()).cast(pa.string()), "<").flatten()
    opened = opened.filter(pc.invert(pc.starts_with(opened, "/")))
    halves = pc.split_pattern(opened, ">", max_splits=1)  # a tag, and the text after it
    ends, texts = np.asarray(halves.offsets), halves.values
    tags = np.asarray(pc.fill_null(pc.index_in(texts, pa.array(_TAGS)), -1))[ends[:-1]].astype(np.int8)
    at = {tag: np.flatnonzero(tags == k) for k, tag in enumerate(_TAGS)}
    hsp, columns = at["Hsp"], {}
    for tag, fields in (("Iteration", _ITERATION), ("Hit", _HIT), ("Hsp", _HSP)):
        begins = at[tag]
        until, own = np.append(begins[1:], len(tags)), np.searchsorted(begins, hsp, "right") - 1
        for column, (name, kind) in fields.items():
            last = np.searchsorted(at[name], until) - 1  # the last of this name before the next of the tag
            found = at[name][last] if len(at[name]) else np.full(len(begins), -1)
            missing = (last < 0) | (found < begins)
            values = _parsed(texts.take(pa.array(ends[found + 1] - 1, mask=missing)), kind)
            columns[column] = values if tag == "Hsp" else values.take(pa.array(own, mask=own < 0))
    return pa.RecordBatch.from_pydict(columns)


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[int]:
    return (k for batch in batches for k in batch.column("id").to_pylist())


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The HSPs of one XML report of any size, each with its hit, its iteration and the program.

    Tasks read ranges of the document that begin with an HSP, a few megabytes at a time, so none holds what one query
    has. A first pass gives one row a range, the heads of the last iteration and hit in it, from which the driver works
    out what is open where each range begins; a second pass reads on from there. Elements are found by their plain
    tags, as the format has them, without prefixes or attributes.
    """
    system, at = Files(spark).of(path)
    size = system.getFileStatus(at).getLen()
    n = max(1, -(-size // RANGE))
    ranges = spark.range(0, n, 1, n)

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k in _numbers(batches):
            found, program = (b"", b""), None
            for text in _report_texts(path, k * RANGE, (k + 1) * RANGE):
                found = _opened(text, found)
                if k == 0 and program is None:
                    program = text.partition(b"<BlastOutput_program>")[2].partition(b"</BlastOutput_program>")[0].decode()
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (k, *found)] + [pa.array([program], pa.string())], ["k", "iteration", "hit", "program"])

    before, now, program = {}, (b"", b""), None
    for row in sorted(ranges.mapInArrow(heads, "k long, iteration binary, hit binary, program string").collect(), key=lambda r: r.k):
        before[row.k], program = now, row.program or program
        now = tuple(bytes(own) or last for own, last in zip((row.iteration, row.hit), now))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k in _numbers(batches):
            opened = before[k]
            for text in _report_texts(path, k * RANGE, (k + 1) * RANGE):
                text = b"".join((*opened, text))
                opened = _opened(text, opened)
                yield _hsps(text)

    schema = ", ".join(f"{column} {kind}" for fields in (_ITERATION, _HIT, _HSP) for column, (_, kind) in fields.items())
    return ranges.mapInArrow(run, schema).withColumn("program", F.lit(program and unescape(program)).cast("string"))


def read_deleted(spark: SparkSession, path: str) -> DataFrame:
    """(entry_key) of a list of deleted entries."""
    return spark.read.text(path).select(F.trim("value").alias("entry_key")).where("entry_key <> ''").distinct()


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of lines with a tab between."""
    parts = F.split("value", "\t", 2)
    return spark.read.text(path).where(F.size(parts) == 2).select(parts[0].alias("key"), parts[1].alias("value"))


def write_metadata(metadata: DataFrame, path: str) -> None:
    """A metadata row as key and value lines."""
    names = {"table_name": "TABLE_NAME", "inc_entries": "INC_ENTRIES", "full_entries": "FULL_ENTRIES", "type": "TYPE", "taxon": "TAXON"}
    pairs = F.array(*[F.concat_ws("\t", F.lit(k), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c, k in names.items()])
    metadata.select(F.explode(pairs).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_files(contents: DataFrame, target: str) -> DataFrame:
    """Write rows (path, content) as files below ``target``, and return (path, size) as written.

    Executors write, a file at a time, through the file system of the target's address. A file
    appears whole, under its own name at the end, so a task that runs again does no harm. Lazy: the
    files are there when the result was read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _drafts(target) as write:
            for batch in batches:
                sizes = [write([content.as_buffer()], path)[0] for path, content in zip(batch.column("path").to_pylist(), batch.column("content"))]
                yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(sizes, pa.int64())], ["path", "size"])

    return contents.select("path", F.coalesce("content", F.lit(b"")).alias("content")).mapInArrow(run, "path string, size long")


def _blocks(path: str) -> Iterator[bytes]:
    system, place = _system(path)
    with system.open_input_stream(place) as stream:
        while block := stream.read(BLOCK):
            yield block


def _streamed(blocks: Iterable, out: pa.NativeFile | None = None) -> tuple[int, str]:
    """(size, SHA-256) of blocks, which are written to ``out`` on the way if it is given."""
    digest, size = hashlib.sha256(), 0
    for block in blocks:
        digest.update(block)
        size += len(block)
        if out is not None:
            out.write(block)
    return size, digest.hexdigest()


@contextmanager
def _drafts(target: str) -> Iterator[Callable[[Iterable, str], tuple[int, str]]]:
    """A function of (blocks, name) that writes a file below ``target`` and gives its size and SHA-256.

    Files are made in a hidden folder of the caller's own, as tasks that make files in one folder wait for each
    other, and are moved to their names when they are whole. The folder goes at the end.
    """
    system, base = _system(target)
    own, folder = f"{base}/.{uuid.uuid4().hex}.part", None

    def write(blocks: Iterable, name: str) -> tuple[int, str]:
        nonlocal folder
        place = f"{base}/{name}"
        if folder is None:
            system.create_dir(own, recursive=True)
        if folder != (folder := place.rsplit("/", 1)[0]):
            system.create_dir(folder, recursive=True)
        with system.open_output_stream(f"{own}/file") as out:
            found = _streamed(blocks, out)
        system.move(f"{own}/file", place)
        return found

    try:
        yield write
    finally:
        if folder is not None:
            system.delete_dir(own)


def _hidden(name: str) -> bool:
    """Whether Spark's own scans pass over a file or folder of this name."""
    return (name[0] == "." or name[0] == "_" and "=" not in name or name.endswith("._COPYING_")) and not name.startswith(("_metadata", "_common_metadata"))


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """(path, below, size) of the files at any depth below ``folder``; no content is read. Below is the path from the folder on.

    Tasks list: one the folder, then each its share of what lies there, twice, and the last time all that is below. A task
    holds what one folder has; the driver has the folder alone. Hidden files are left out, empty ones are not.
    """
    system, at = Files(spark).of(folder)
    roots = [(s.getPath().toString(), None if s.isDirectory() else s.getLen()) for s in system.globStatus(at) or ()]
    if not roots:
        raise FileNotFoundError(folder)

    def rows(found: list[tuple[str, int | None]]) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(found), 10_000):
            paths, sizes = zip(*found[k : k + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], ["path", "size"])

    def inner(path: str) -> list[tuple[str, int | None]]:
        system, place = _system(path)
        found = [x for x in system.get_file_info(FileSelector(place)) if not _hidden(x.base_name)]
        return [(f"{path.rstrip('/')}/{x.base_name}", x.size) for x in found if x.type in (FileType.File, FileType.Directory)]

    def opened(deep: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pc.is_valid(batch["size"]))  # files; folders have no size
                folders = batch.filter(pc.is_null(batch["size"]))["path"].to_pylist()
                while folders:
                    found = inner(folders.pop())
                    if deep:
                        folders += [path for path, size in found if size is None]
                        found = [x for x in found if x[1] is not None]
                    yield from rows(found)

        return run

    found, schema = spark.createDataFrame(roots, "path string, size long"), "path string, size long"
    for deep in (False, False, True):
        found = found.repartition(spark.sparkContext.defaultParallelism, "path").mapInArrow(opened(deep), schema)
    base = folder.rstrip("/") + "/"
    return found.select("path", F.substring_index("path", base, -1).alias("below"), "size")


def measured(files: DataFrame, target: str | None = None) -> DataFrame:
    """``files`` (path, below, size) with ``hash``, the SHA-256 of each, and copied to ``target``/below if one is given.

    Files may be of any size: a task holds a block of one at a time, and works the hash out as it reads. Size
    is that of what was read. A task that runs again writes the same files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _drafts(target) if target is not None else nullcontext(lambda blocks, name: _streamed(blocks)) as write:
            for batch in batches:
                paths, names = batch.column("path"), batch.column("below")
                found = [write(_blocks(path), name) for path, name in zip(paths.to_pylist(), names.to_pylist())]
                sizes, digests = zip(*found) if found else ((), ())
                yield pa.RecordBatch.from_arrays([paths, names, pa.array(sizes, pa.int64()), pa.array(digests, pa.string())], ["path", "below", "size", "hash"])

    # dealt by number, as the rows' bytes say nothing about the work
    dealt = files.select("path", "below", "size").repartition(4 * files.sparkSession.sparkContext.defaultParallelism, "path")
    return dealt.mapInArrow(run, "path string, below string, size long, hash string")


def copy_files(files: DataFrame, source: str, target: str) -> DataFrame:
    """Copy the files of a manifest (path below ``source``) to ``target``, and return (path, size, hash) as written.

    Contents never reach the driver, and are not held whole anywhere.
    """
    wanted = listed(files.sparkSession, source).join(files.select(F.col("path").alias("below")).distinct(), "below", "left_semi")
    return measured(wanted, target).select(F.col("below").alias("path"), "size", "hash")
