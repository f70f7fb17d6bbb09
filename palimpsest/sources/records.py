"""Records cut out of text files, which are read in splits.

However a file falls into splits, the records are the same: where a split ends inside a record, what is
left of it at the head of later splits is stitched on.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Files that close a release, see :mod:`palimpsest.streaming.ingest`; they hold no records.
MARKER = r"/\d+\.done$"

def read_records(spark: SparkSession, path: str | list[str], separator: str, start: str | None = None) -> DataFrame:
    """(file, block, record) of text cut at a literal separator, by Spark's splittable text source.

    Compressed files are read too; block is the byte at which the record's split begins. The separator
    is a line end and the first characters of a line, so records of files with CRLF line ends are cut
    alike, and keep what stands on that line after them. With ``start``, which begins every record and of
    which only a file's first keeps it, lines before the first start of a file are skipped.
    """
    meta = F.col("_metadata")
    lines = spark.read.option("lineSep", separator).option("recursiveFileLookup", True).text(path).where(~meta["file_path"].rlike(MARKER))
    rows = lines.select(meta["file_path"].alias("file"), F.col("value").alias("record"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("at"))
    if start is None:
        return rows.select("file", "block", "record")
    # a file's first record is the first row of its first split; just the places of those that are none of the format are sent
    # out, and as only longs are aggregated, no text is sorted or dealt for them
    head = F.when(F.col("block") == 0, F.col("at"))
    heads = rows.select("file", head.alias("at"), F.when(~F.ltrim("record").startswith(start), head).alias("other"))
    firsts = heads.groupBy("file").agg(F.min("at").alias("at"), F.min("other").alias("other"))
    return rows.join(F.broadcast(firsts.where("at = other").select("at")), "at", "left_anti").select("file", "block", "record")


def read_records_by_pattern(spark: SparkSession, path: str | list[str], start: str, stop: str | None = None) -> DataFrame:
    """(file, block, ordinal, record) of files cut where a whole line matches ``start``.

    Lines before the first start of a file are skipped; a line that matches ``stop`` ends a record and is
    not part of it; a last record without an end is kept. Lines may end in either way; within a record they
    are joined by newlines. Records are in the order of block, where their first line's split begins, and
    ordinal.

    Each split is cut alone, in one pass over its lines. What stands before its first start goes, with the
    records that splits end in, to a small table of pieces by file and block, where pieces are given to the
    last block before theirs that began a record. So a file may be of any size and a record may run over
    any number of splits; only one record's pieces meet in a task.
    """
    meta = F.col("_metadata")
    lines = spark.read.option("recursiveFileLookup", True).text(path).where(~meta["file_path"].rlike(MARKER))
    rows = lines.select(meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), F.col("value").alias("line"), F.col("value").rlike(rf"\A(?:{start})\z").alias("begins"))
    pieces = rows.mapInArrow(_cut_splits, "file string, block long, ordinal long, part string, record string")
    whole = pieces.where("part = 'whole'").select("file", "block", "ordinal", "record")
    loose = pieces.where("part <> 'whole'")
    places = loose.groupBy("file", "block").agg(F.max(F.when(F.col("part") == "tail", F.col("ordinal"))).alias("tail"))
    before = Window.partitionBy("file").orderBy("block")
    owner = F.when(F.col("tail").isNotNull(), F.struct("block", F.col("tail").alias("ordinal")))
    owned = places.select("file", "block", F.last(owner, ignorenulls=True).over(before.rowsBetween(Window.unboundedPreceding, -1)).alias("of"))
    heads = loose.where("part = 'head'").join(owned, ["file", "block"]).where("of IS NOT NULL").select("file", F.col("of.block").alias("of_block"), F.col("of.ordinal").alias("ordinal"), "block", "record")
    tails = loose.where("part = 'tail'").select("file", F.col("block").alias("of_block"), "ordinal", F.lit(-1).cast("long").alias("block"), "record")
    joined = tails.unionByName(heads).groupBy("file", "of_block", "ordinal").agg(F.array_sort(F.collect_list(F.struct("block", "record"))).alias("p"))
    stitched = joined.select("file", F.col("of_block").alias("block"), "ordinal", F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"))
    return whole.unionByName(stitched).select("file", "block", "ordinal", _before_stop(F.col("record"), stop).alias("record"))


def _before_stop(record: Column, stop: str | None) -> Column:
    """A record up to the first of its further lines that matches ``stop``."""
    return record if stop is None else F.element_at(F.split(record, rf"(?md)\n(?:{stop})$", 2), 1)


def _cut_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each split in reading order: ``whole`` ones, the ``head`` before its first start, and the last, its ``tail``."""
    place, ordinal, lines, part = None, 0, [], "head"

    def closed(last: str) -> tuple | None:
        name = part if part == "head" else last
        return (*place, ordinal, name, "\n".join(lines)) if lines else None

    def out(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["file", "block", "ordinal", "part", "record"])

    for batch in batches:
        rows = []
        for file, block, line, begins in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "line", "begins"))):
            if (file, block) != place:
                if place is not None and (row := closed("tail")):
                    rows.append(row)
                place, ordinal, lines, part = (file, block), 0, [], "head"
            if begins:
                if row := closed("whole"):
                    rows.append(row)
                ordinal, lines, part = ordinal + 1, [], "whole"
            lines.append(line)
        if rows:
            yield out(rows)
    if place is not None and (row := closed("tail")):
        yield out([row])


def cut_by_pattern(files: DataFrame, start: str, stop: str | None = None) -> DataFrame:
    """(file, ordinal, record) from rows (file, value) that each hold a whole text; see :func:`read_records_by_pattern`."""
    pieces = files.select("file", F.posexplode(F.split("value", rf"(?m)(?=^(?:{start})$)")).alias("ordinal", "record"))
    pieces = pieces.where(F.col("record").rlike(rf"(?m)\A(?:{start})$"))
    record = F.col("record")
    if stop is not None:
        record = F.element_at(F.split(record, rf"(?m)^(?:{stop})$", 2), 1)
    return pieces.select("file", "ordinal", F.regexp_replace(record, r"\n\z", "").alias("record"))
