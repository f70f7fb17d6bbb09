"""Reads of the versioned tables: as of a version, or over a window of versions.

``cells`` has entry_key, field, version, value, is_tombstone; ``presence`` entry_key, version. Both
are partitioned by version in the store, so that version bounds prune files. What the store keeps, a row for
an entry and version, is (entry_key, version, cells array<field, value>, present); a null value is a tombstone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .diff import differing


def in_window(rows: DataFrame, start: int | None = None, stop: int | None = None) -> DataFrame:
    """Rows with start <= version <= stop; a missing bound is open."""
    if start is not None:
        rows = rows.where(F.col("version") >= start)
    return rows if stop is None else rows.where(F.col("version") <= stop)


def newest_cells(cells: DataFrame, start: int | None = None, stop: int | None = None, keys: Sequence[str] = ("entry_key",)) -> DataFrame:
    """The newest cell of each entry and field in the window, tombstones included.

    The newest version is found by a hash aggregation over keys and longs, so that values take no
    part in a sort; they come back by joining on key, field and version.
    """
    rows = in_window(cells, start, stop)
    by = [*keys, "field"]
    newest = rows.groupBy(*by).agg(F.max("version").alias("version"))
    return rows.join(newest, [*by, "version"], "left_semi")


def state(cells: DataFrame, stop: int | None = None, fields: Sequence[str] | None = None, keys: Sequence[str] = ("entry_key",)) -> DataFrame:
    """(entry_key, fields, versions): the live fields of each entry as of ``stop`` and when each was set.

    With ``fields`` only these are read: the filter reaches the scan before anything is pivoted.
    """
    if fields is not None:
        cells = cells.where(F.col("field").isin(*fields))
    live = newest_cells(cells, None, stop, keys).where(~F.col("is_tombstone"))
    entries = F.array_sort(F.collect_list(F.struct("field", "value", "version")))
    return live.groupBy(*keys).agg(entries.alias("c")).select(
        *keys, F.map_from_arrays("c.field", "c.value").alias("fields"), F.map_from_arrays("c.field", "c.version").alias("versions")
    )


def last_seen(presence: DataFrame, start: int | None = None, stop: int | None = None, keys: Sequence[str] = ("entry_key",)) -> DataFrame:
    return in_window(presence, start, stop).groupBy(*keys).agg(F.max("version").alias("last_version"))


def deleted_in_window(presence: DataFrame, start: int | None, stop: int, keys: Sequence[str] = ("entry_key",)) -> DataFrame:
    """Entries seen in the window but not at its end; those last seen before it are not reported."""
    return last_seen(presence, start, stop, keys).where(F.col("last_version") < stop).select(*keys)


def present_at(presence: DataFrame, stop: int, keys: Sequence[str] = ("entry_key",)) -> DataFrame:
    return presence.where(F.col("version") == stop).select(*keys).distinct()


def changed_required(cells: DataFrame, start: int | None, stop: int, required: Sequence[str], keys: Sequence[str] = ("entry_key",)) -> DataFrame:
    """(entry_key, level) of entries with cells in the window: 1 if all required fields changed, 0 if
    none, -1 if some; a field that vanished changed. An entry with any required change is due for output."""
    hit = F.count_distinct(F.when(F.col("field").isin(*required), F.col("field")))
    level = F.when(hit == 0, 0).when(hit == len(required), 1).otherwise(-1)
    return in_window(cells, start, stop).groupBy(*keys).agg(level.cast("int").alias("level"))


def incremental(cells: DataFrame, presence: DataFrame, start: int | None, stop: int, required: Sequence[str], complete: bool = False,
                fields: Sequence[str] | None = None, keys: Sequence[str] = ("entry_key",)) -> DataFrame:
    """Entries present at ``stop`` with a required field changed in the window, as of ``stop``.

    ``complete`` is for formats that cannot tell a change: every entry present is returned. The
    window's cells decide; only the chosen entries' history is read, by a semi-join.
    """
    chosen = present_at(presence, stop, keys)
    if not complete:
        due = changed_required(cells, start, stop, required, keys).where("level <> 0").select(*keys)
        chosen = chosen.join(due, [*keys], "left_semi")
    return state(cells.join(chosen, [*keys], "left_semi"), stop, fields, keys)


def signature(value: Column) -> Column:
    """What tells values apart as they do themselves: a short value, or the SHA-256 of a long one."""
    return F.when(F.length(value) > 64, F.concat(F.lit("#"), F.sha2(value, 256))).otherwise(F.concat(F.lit("="), value))


def signed(rows: DataFrame) -> DataFrame:
    """Stored rows with signatures for their values, so that states compare without moving values."""
    return rows.withColumn("cells", F.transform("cells", lambda c: F.struct(c["field"].alias("field"), signature(c["value"]).alias("value"))))


def as_cells(fields: Column) -> Column:
    """A map of fields as cells."""
    return F.transform(F.map_entries(fields), lambda e: F.struct(e["key"].alias("field"), e["value"].alias("value")))


_STATE = "map<string,struct<value:string,version:bigint>>"


def _newest(of: Column) -> Column:
    """Field to its newest value and version, from (version, cells) in order of version."""
    cells = lambda x: F.map_from_entries(F.transform(x["cells"], lambda c: F.struct(c["field"], F.struct(c["value"].alias("value"), x["version"].alias("version")))))
    return F.aggregate(of, F.create_map().cast(_STATE), lambda acc, x: F.map_zip_with(acc, cells(x), lambda _, a, b: F.coalesce(b, a)))


def merged(rows: DataFrame, keys: Sequence[str] = ("entry_key",), once: bool = False, stop: int | None = None) -> DataFrame:
    """(keys, fields, versions) of stored rows, as :func:`state` gives it for cells: values are dealt by key once.

    With ``once`` no key is there twice, and nothing is dealt. With ``stop`` entries of that version stay though
    they have no fields, and ``present`` says whether its release had them.
    """
    if once and stop is None:
        kept = rows.select(*keys, "version", F.filter("cells", lambda c: c["value"].isNotNull()).alias("_live")).where(F.size("_live") > 0)
        return kept.select(*keys, F.map_from_entries("_live").alias("fields"), F.map_from_entries(F.transform("_live", lambda c: F.struct(c["field"], F.col("version")))).alias("versions"))
    grouped = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("version", "cells"))).alias("_of"), F.max(F.col("present") & (F.col("version") == F.lit(stop))).alias("present"))
    live = grouped.select(*keys, F.map_filter(_newest(F.col("_of")), lambda _, c: c["value"].isNotNull()).alias("_live"), "present")
    fields, versions = F.transform_values("_live", lambda _, c: c["value"]).alias("fields"), F.transform_values("_live", lambda _, c: c["version"]).alias("versions")
    found = live.where(F.size("_live") > 0 if stop is None else (F.size("_live") > 0) | F.col("present"))
    return found.select(*keys, fields, versions, *(["present"] if stop is not None else []))


def compared_again(history: DataFrame, version: int, after: int) -> DataFrame:
    """(entry_key, cells, present) of the slice ``after``, the next one, when ``version`` is put.

    ``history`` has the stored rows up to ``after`` as they were, and the new ones of ``version``, signed, with
    ``fresh``. Entries of the old and of the new release are compared with their state before ``after``; the
    others stay as they were. One grouping by key does it.
    """
    row = F.struct("version", "fresh", "cells", "present")
    of = history.groupBy("entry_key").agg(F.array_sort(F.collect_list(row)).alias("_of"))
    was = lambda x: ~x["fresh"] & (x["version"] == version)
    own = F.get(F.filter("_of", lambda x: ~x["fresh"] & (x["version"] == after)), F.lit(0))
    value = lambda x: F.when(x["fresh"], x["cells"]).otherwise(F.transform(x["cells"], lambda c: F.struct(c["field"].alias("field"), signature(c["value"]).alias("value"))))
    earlier = F.filter("_of", lambda x: x["fresh"] | (x["version"] < version))
    live = lambda state: F.transform_values(F.map_filter(state, lambda _, c: c["value"].isNotNull()), lambda _, c: c["value"])
    base = live(_newest(F.transform(earlier, lambda x: F.struct(x["version"].alias("version"), value(x).alias("cells")))))
    then = live(_newest(F.filter("_of", lambda x: ~x["fresh"])))
    rows = of.select("entry_key", F.exists("_of", lambda x: x["fresh"] | was(x)).alias("touched"), own.alias("own"), base.alias("base"), then.alias("then"))
    cells = F.when(F.col("touched"), differing(F.col("base"), F.col("then"), signature)).otherwise(F.col("own.cells"))
    out = rows.select("entry_key", cells.alias("cells"), F.coalesce("own.present", F.lit(False)).alias("present"))
    return out.where(F.col("present") | (F.size("cells") > 0))


def incremental_merged(rows: DataFrame, presence: DataFrame, start: int | None, stop: int, required: Sequence[str], complete: bool, keys: Sequence[str], once: bool) -> DataFrame:
    """:func:`incremental` of stored rows. With ``once`` they are those of ``stop`` alone, which say themselves what is due."""
    due = F.arrays_overlap(F.col("cells.field"), F.array(*map(F.lit, required))) if not complete else F.lit(True)
    if once:
        return merged(rows.where(F.col("present") & due), keys, once)
    chosen = present_at(presence, stop, keys)
    if not complete:
        chosen = chosen.join(in_window(rows, start, stop).where(due).select(*keys).distinct(), [*keys], "left_semi")
    return merged(in_window(rows, None, stop).join(chosen, [*keys], "left_semi"), keys)
