"""Column functions used across formats and operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trim_control(col: Column) -> Column:
    """Strip characters up to and including the space, control characters too, from both ends."""
    return F.trim(col, F.lit("".join(map(chr, range(0x21)))))


def squeeze_sequence(col: Column) -> Column:
    """A sequence without its blanks, NULs and line ends."""
    return F.translate(col, " \x00\n\r", "")


def task_key(task: Column | int) -> Column:
    """Task number with four digits."""
    return F.lpad((F.lit(task) if isinstance(task, int) else task).cast("string"), 4, "0")


def path_suffix(path: Column) -> Column:
    """From the last dot of the base name, or empty."""
    return F.regexp_extract(path, r"(\.[^./]*)$", 1)


def path_parent(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def cache_key(collection: Column, start: Column, stop: Column, regex: Column, addendum: Column, split: Column, run_id: Column, task_id: Column, is_database: Column) -> Column:
    """Name of a stored result: what was asked for, and by which run unless the collection is shared."""
    scope = F.when(is_database, F.lit("")).otherwise(F.concat_ws("_", F.lit(""), run_id, task_id))
    shared = F.concat_ws("_", collection, start.cast("string"), stop.cast("string"), F.md5(F.coalesce(regex, F.lit(""))), F.coalesce(addendum, F.lit("")), split.cast("string"))
    return F.concat(shared, scope)


def rescaled(evalue: Column, full: Column, incremental: Column) -> Column:
    """An e-value from a search of the increment, as the full collection would give it."""
    return evalue * F.when((full > 0) & (incremental > 0), full / incremental).otherwise(F.lit(1.0))
