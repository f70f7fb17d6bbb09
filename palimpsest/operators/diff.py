"""Differences between releases, by field and by entry.

A release is a DataFrame (entry_key, fields map<string,string>); an entry occurs once in it. A null
value in the map counts as a missing field.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def to_release(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """A release from a wide table: columns become fields, nulls are left out."""
    pairs = F.filter(F.array(*[F.struct(F.lit(f).alias("k"), F.col(f).cast("string").alias("v")) for f in fields]), lambda p: p["v"].isNotNull())
    return df.select(F.col(key).cast("string").alias("entry_key"), F.map_from_entries(pairs).alias("fields"))


def paired(old: DataFrame, new: DataFrame) -> DataFrame:
    """Both states of every entry of either release: one shuffle join on the key."""
    return old.select("entry_key", F.col("fields").alias("old")).join(new.select("entry_key", F.col("fields").alias("new")), "entry_key", "full")


def entry_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(entry_key, change): added, removed, modified or kept."""
    differs = F.exists(F.map_values(F.map_zip_with("old", "new", lambda _, a, b: ~a.eqNullSafe(b))), lambda x: x)
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(differs, "modified").otherwise("kept")
    return paired(old, new).select("entry_key", change.alias("change"))


def differing(old: Column, new: Column, sign: Callable[[Column], Column] = lambda value: value) -> Column:
    """(field, value) of the fields that turn ``old`` into ``new``; a null value for a field that vanished. ``old`` may hold signatures of values."""
    pairs = F.map_entries(F.map_zip_with(old, new, lambda _, a, b: F.struct(b.alias("value"), a.eqNullSafe(sign(b)).alias("same"))))
    return F.transform(F.filter(pairs, lambda e: ~e["value"]["same"]), lambda e: F.struct(e["key"].alias("field"), e["value"]["value"].alias("value")))


def changes(old: DataFrame, new: DataFrame, here: DataFrame, sign: Callable[[Column], Column] = lambda value: value) -> DataFrame:
    """(entry_key, change, cells) of a release against the state before it, from one pass over both.

    ``old`` holds every entry ever seen, ``here`` the keys of the release before: of it are added,
    removed, modified and kept told, while ``cells`` (field, value) are relative to ``old``, so an
    entry that comes back has only what changed since. ``old`` may hold ``sign`` of its values; as it meets
    ``here`` first, the values of ``new`` are dealt by key once.
    """
    empty = F.create_map().cast("map<string,string>")
    known = old.select("entry_key", F.col("fields").alias("old")).join(here.select("entry_key", F.lit(True).alias("was")), "entry_key", "full")
    both = known.join(new.select("entry_key", F.col("fields").alias("new")), "entry_key", "full").where("old IS NOT NULL OR new IS NOT NULL")
    first = F.filter(F.transform(F.map_entries("new"), lambda e: F.struct(e["key"].alias("field"), e["value"].alias("value"))), lambda c: c["value"].isNotNull())
    cells = F.when(F.col("old").isNull(), first).otherwise(differing(F.coalesce("old", empty), F.col("new"), sign))
    change = F.when(F.col("new").isNull(), "removed").when(F.col("was").isNull(), "added").when(F.size("cells") > 0, "modified").otherwise("kept")
    return both.where(F.col("new").isNotNull() | F.col("was")).withColumn("cells", cells).select("entry_key", change.alias("change"), "cells")


def exploded(changes: DataFrame) -> DataFrame:
    """(entry_key, field, value, is_tombstone) of the cells of :func:`changes`."""
    rows = changes.select("entry_key", F.explode("cells").alias("c"))
    return rows.select("entry_key", "c.field", "c.value", F.col("c.value").isNull().alias("is_tombstone"))


def changed_fields(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows (entry_key, field, value, is_tombstone) that turn ``old`` into ``new`` for the entries of ``new``.

    New and changed fields carry their value; fields that vanished are tombstones; entries missing
    from ``new`` have none, as their absence shows in the presence table alone.
    """
    both = new.select("entry_key", F.col("fields").alias("new")).join(old.select("entry_key", F.col("fields").alias("old")), "entry_key", "left")
    return exploded(both.select("entry_key", differing(F.coalesce("old", F.create_map().cast("map<string,string>")), F.col("new")).alias("cells")))


def equal_fields(old: DataFrame, new: DataFrame) -> DataFrame:
    """(entry_key, fields): names, in order, of the fields that are equal in both releases."""
    both = paired(old, new).where(F.col("old").isNotNull() & F.col("new").isNotNull())
    same = F.map_keys(F.map_filter("new", lambda k, v: F.element_at("old", k) == v))
    return both.select("entry_key", F.array_sort(same).alias("fields"))


def vanished_fields(old: DataFrame, new: DataFrame) -> DataFrame:
    """(entry_key, field) for fields of an entry in both releases that only ``old`` has."""
    both = paired(old, new).where(F.col("old").isNotNull() & F.col("new").isNotNull())
    return both.select("entry_key", F.explode(F.array_except(F.map_keys("old"), F.map_keys("new"))).alias("field"))


def elide_unchanged(observations: DataFrame, keys: tuple[str, ...] = ("entry_key", "field"), version: str = "version", value: str = "value") -> DataFrame:
    """The change log of dense observations: rows whose value differs from the one before."""
    order = Window.partitionBy(*keys).orderBy(version)
    marked = observations.withColumn("_before", F.lag(value).over(order)).withColumn("_first", F.row_number().over(order) == 1)
    return marked.where(F.col("_first") | ~F.col(value).eqNullSafe(F.col("_before"))).drop("_before", "_first")
