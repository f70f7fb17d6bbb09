"""A file tree as a table: (path, size, hash, version, is_deleted), one row per path.

Trees are read by prefix filters, which Parquet scans push down, and path joins by equality.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import listed, measured


def live(files: DataFrame) -> DataFrame:
    return files.where(~F.col("is_deleted"))


def _folder(path: str) -> str:
    return path if not path or path.endswith("/") else path + "/"


def ls_rec(files: DataFrame, path: str) -> DataFrame:
    """All live files below ``path`` with their path from there on."""
    base = _folder(path)
    return live(files).where(F.col("path").startswith(base)).withColumn("suffix", F.substr("path", F.lit(len(base) + 1)))


def ls(files: DataFrame, path: str) -> DataFrame:
    """Live files directly in ``path``."""
    return ls_rec(files, path).where(~F.col("suffix").contains("/"))


def get_file(files: DataFrame, path: str) -> DataFrame:
    return live(files).where(F.col("path") == path)


def get_files(files: DataFrame, part: str) -> DataFrame:
    """Live files whose path contains ``part``."""
    return live(files).where(F.col("path").contains(part))


def file_size(files: DataFrame, path: str) -> DataFrame:
    """One row: the size of the file, null if there is none."""
    return get_file(files, path).agg(F.max("size").alias("size"))


def ancestors(path: Column) -> Column:
    """Every prefix of ``path`` that ends before a slash, and the path itself, shortest first."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def super_paths(requests: DataFrame, existing: DataFrame) -> DataFrame:
    """``requests`` (path) with super_path, the longest ancestor or self among ``existing`` (path), or null.

    Each request meets existing paths by equality of its few ancestors: an equi-join on paths.
    """
    steps = requests.select("path", F.explode(ancestors(F.col("path"))).alias("super_path"))
    found = steps.join(existing.select(F.col("path").alias("super_path")).distinct(), "super_path").groupBy("path").agg(
        F.max_by("super_path", F.length("super_path")).alias("super_path")
    )
    return requests.join(found, "path", "left")


def put_files(old: DataFrame, new: DataFrame) -> DataFrame:
    """``new`` (path, size, hash) against ``old``: unchanged where the hash is equal (the stored copy
    and its version stay), replaced where it differs, else new."""
    before = old.select("path", F.col("hash").alias("old_hash"), F.col("version").alias("old_version"))
    state = F.when(F.col("old_hash").isNull(), "new").when(F.col("old_hash") == F.col("hash"), "unchanged").otherwise("replaced")
    return new.join(before, "path", "left").withColumn("state", state)


def soft_delete(files: DataFrame, path: str, version: int, tree: bool = False) -> DataFrame:
    """Files with those at ``path``, or below it with ``tree``, marked deleted at ``version``.

    A later put of the path brings it back: the mark holds for the version it was made at.
    """
    hit = F.col("path").startswith(_folder(path)) if tree else F.col("path") == path
    return files.withColumn("version", F.when(hit, F.lit(version)).otherwise(F.col("version"))).withColumn("is_deleted", F.col("is_deleted") | hit)


def newest_state(log: DataFrame) -> DataFrame:
    """The newest row of each path of an append-only log; of one version a put outranks a deletion."""
    others = [c for c in log.columns if c != "path"]
    order = F.struct("version", (~F.col("is_deleted")).alias("live"))
    return log.groupBy("path").agg(F.max_by(F.struct(*others), order).alias("_row")).select("path", "_row.*").select(*log.columns)


def from_folder(spark: SparkSession, folder: str, version: int) -> DataFrame:
    """Manifest rows of the files below a folder, of any size; contents are hashed where they are read."""
    found = measured(listed(spark, folder))
    return found.select("path", "size", "hash", F.lit(version).cast("long").alias("version"), F.lit(False).alias("is_deleted"))
