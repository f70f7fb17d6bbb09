"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, dealt_anew


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node for every node of ``edges``.

    ``edges`` has two columns of one orderable type, null nowhere; repeated edges and loops are
    harmless. Returns (node, component) for nodes with an edge to another node; an empty table
    gives an empty table. Each step is two aggregations and two joins over at most as many rows as
    there are edges, so no neighbourhood is ever gathered. A hub is a skewed join key, which
    adaptive execution splits. The table is cut after each round, and a round's count and checksum
    say when nothing changes any more.
    """
    a, b = edges.columns
    current = cut(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    before = None
    while True:
        state = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if state == before or state.n == 0:
            break
        before = state
        current = cut(_small_star(_large_star(current)))
    return current.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = dealt_anew(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "u").drop("u")
    return (
        dealt_anew(both.where(F.col("v") > F.col("u")), "u").join(least, "dealt")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = dealt_anew(edges, "u").join(dealt_anew(least, "u").drop("u"), "dealt").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
