"""Versions, runs and what a run is due."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_versions(requests: DataFrame, versions: DataFrame) -> DataFrame:
    """``requests`` (collection, run_id, task_id) with the latest version: the run's and task's own,
    else the collection's, else null. Two aggregates over the small registry, joined by key."""
    scoped = versions.where(F.col("run_id").isNotNull()).groupBy("collection", "run_id", "task_id").agg(F.max("version").alias("_own"))
    shared = versions.groupBy("collection").agg(F.max("version").alias("_any"))
    return requests.join(scoped, ["collection", "run_id", "task_id"], "left").join(shared, "collection", "left").select(
        "collection", "run_id", "task_id", F.coalesce("_own", "_any").alias("version")
    )


def incremental_windows(requests: DataFrame, runs: DataFrame, latest: DataFrame, first: int = 1) -> DataFrame:
    """(run_id, collection, start, stop, status) of each request.

    start is the version after the one last recorded for the run and collection, or ``first``; stop
    the collection's latest; status is ``unchanged`` when start lies beyond stop.
    """
    last = runs.groupBy("run_id", "collection").agg(F.max_by("version", F.struct("recorded_at", "version")).alias("_last"))
    found = requests.join(last, ["run_id", "collection"], "left").join(latest.select("collection", F.col("version").alias("stop")), "collection", "left")
    start = F.coalesce(F.col("_last") + 1, F.lit(first))
    return found.select("run_id", "collection", start.alias("start"), "stop", F.when(start > F.col("stop"), "unchanged").otherwise("new").alias("status"))


def lineage_report(runs: DataFrame) -> DataFrame:
    """One row per run and collection: what was last delivered, how and when."""
    order = F.struct("recorded_at", "version")
    return runs.groupBy("run_id", "collection").agg(
        F.max_by("direction", order).alias("direction"), F.max_by("version", order).alias("version"), F.max_by("path", order).alias("path"),
        F.max_by("regex", order).alias("regex"), F.count("*").alias("n_records"),
    )


def suffixed_lineage(rows: DataFrame) -> DataFrame:
    """Lineage rows (run_id, column, value) with columns X, X_db_timestamp, X_filename, X_regex per
    file X, as one record (run_id, file, type, db_timestamp, filename, regex) per file."""
    pattern = r"^(.*?)(?:_(db_timestamp|filename|regex))?$"
    split = rows.select("run_id", F.regexp_extract("column", pattern, 1).alias("file"), F.regexp_extract("column", pattern, 2).alias("kind"), "value")
    part = lambda kind, name: F.max(F.when(F.col("kind") == kind, F.col("value"))).alias(name)
    return split.groupBy("run_id", "file").agg(
        part("", "type"), part("db_timestamp", "db_timestamp"), part("filename", "filename"), part("regex", "regex")
    )


def append_paths(known: DataFrame, new: DataFrame) -> DataFrame:
    """Materialised paths without repeats: of rows for one path the known one stays."""
    both = known.withColumn("_rank", F.lit(0)).unionByName(new.withColumn("_rank", F.lit(1)))
    others = [c for c in known.columns if c != "path"]
    return both.groupBy("path").agg(F.min_by(F.struct(*others), "_rank").alias("_row")).select("path", "_row.*").select(*known.columns)
