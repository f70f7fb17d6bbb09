"""Counters of puts and gets, and sequence statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .asof import deleted_in_window


def change_counters() -> dict[str, Column]:
    """Over entry changes: entries put, new ones, changed ones, and those no longer there."""
    of = lambda *kinds: F.count_if(F.col("change").isin(*kinds))
    return {"n_entries": of("added", "modified", "kept"), "n_new": of("added"), "n_modified": of("modified"), "n_deleted": of("removed")}


def ingest_counters(changes: DataFrame) -> DataFrame:
    """One row of :func:`change_counters`."""
    return changes.agg(*[c.alias(n) for n, c in change_counters().items()])


def get_metadata(existing: DataFrame | int, presence: DataFrame, start: int | None, stop: int, collection: str, kind: str, addendum: str = "", spark: SparkSession | None = None) -> DataFrame:
    """One row: incremental and full entry counts, deleted entries, and what was asked for.

    ``existing`` are the entries got, or, where they were counted before, how many they are (with ``spark``).
    """
    full = presence.where(F.col("version") == stop).agg(F.count_distinct("entry_key").alias("full_entries"))
    deleted = deleted_in_window(presence, start, stop).agg(F.count("*").alias("deleted_entries"))
    part = spark.range(1).select(F.lit(existing).cast("long").alias("inc_entries")) if isinstance(existing, int) else existing.agg(F.count("*").alias("inc_entries"))
    return part.crossJoin(F.broadcast(full)).crossJoin(F.broadcast(deleted)).select(
        F.lit(collection).alias("table_name"), "inc_entries", "full_entries", "deleted_entries", F.lit(kind).alias("type"), F.lit(addendum).alias("taxon")
    )


def count_records(lines: DataFrame, start: str = ">", col: str = "value") -> DataFrame:
    """How many lines begin a record."""
    return lines.where(F.col(col).startswith(start)).agg(F.count("*").alias("n_entries"))


def base_pairs(lines: DataFrame, file: str = "file", col: str = "value") -> DataFrame:
    """Base pairs, contigs and mean contig length per file, and in total (file null).

    ``lines`` has a file name and a line; lines that begin with ``>`` head a contig.
    """
    head = F.col(col).startswith(">")
    bases = F.coalesce(F.sum(F.when(~head, F.length(F.trim(col)))), F.lit(0))
    out = lines.rollup(file).agg(bases.alias("base_pairs"), F.count_if(head).alias("contigs"), F.count_distinct(file).alias("files"))
    return out.withColumn("mean_length", F.when(F.col("contigs") > 0, F.floor(F.col("base_pairs") / F.col("contigs"))))
