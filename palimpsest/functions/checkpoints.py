"""Cutting lineage, and scratch folders, where all executors can read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A new folder beside the checkpoints: in the cluster's spark.checkpoint.dir; a local session may do without it."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    return f"{context.getCheckpointDir()}/{uuid.uuid4()}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder and cut its lineage there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def numbered(rows: DataFrame, name: str, *order: Column) -> DataFrame:
    """``rows`` with their rank from 1 in ``order`` (of distinct values), without one task that holds them all.

    They are dealt by range and written; a task's own row numbers plus the row counts of the ranges
    before it are the ranks. The window over counts has a row per partition.
    """
    parts = max(1, rows.sparkSession.sparkContext.defaultParallelism)
    dealt = cut(rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    counts = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return dealt.withColumn("_own", own).join(F.broadcast(before), "_part").withColumn(name, (F.col("_own") + F.col("_before")).cast("long")).drop("_part", "_own", "_before")
