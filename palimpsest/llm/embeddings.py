"""Embedding near-duplicates by int8 tile products with rigorous error bounds.

Vectors of one label are quantised once and dealt to tiles of bounded size; each pair of tiles that
could hold a link is one unit of work, to which only int8 codes and their error bounds travel. There
they are multiplied as a block; a pair whose product plus its error bound stays under the threshold
is out for certain. Vectors with a pair that is not out travel again, in double precision, to be
computed exactly. Equal vectors are one node, so a group of copies costs one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .components import connected_components

#: Vectors in a tile at most, on average; a unit of work holds two tiles.
TILE = 1024
_LEVELS = 127


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of unit vectors, their scale, the norm of scale * code, and the norm of the rest.

    Norms are rounded up by far more than double precision can err by.
    """
    scale = np.abs(unit).max(axis=1, initial=0) / _LEVELS
    codes = np.rint(unit / np.where(scale > 0, scale, 1)[:, None]).astype(np.int8)
    near = codes * scale[:, None]
    up = 1 + 1e-9
    return codes, scale, np.linalg.norm(near, axis=1) * up, np.linalg.norm(unit - near, axis=1) * up + 1e-12


def candidates(left: tuple, right: tuple, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose product of quantised vectors does not rule out the threshold.

    |u.v - (s a).(t b)| <= |s a||f| + |e||t b| + |e||f| for u = s a + e and v = t b + f. Products of
    int8 codes are summed in float32 blocks of 1024 dimensions, where they are whole numbers under
    2 ** 24 and so exact.
    """
    (a, s, na, ea), (b, t, nb, eb) = left, right
    product = np.zeros((len(a), len(b)))
    for k in range(0, max(a.shape[1], 1), 1024):
        product += a[:, k : k + 1024].astype(np.float32) @ b[:, k : k + 1024].astype(np.float32).T
    bound = na[:, None] * eb[None] + ea[:, None] * (nb + eb)[None]
    return np.nonzero(product * s[:, None] * t[None] + bound >= threshold - 1e-9)


def tile_candidates(a: tuple, b: tuple, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs between two tiles of quantised vectors, in blocks of 512 rows."""
    for start in range(0, len(a[0]), 512):
        i, j = candidates(tuple(x[start : start + 512] for x in a), b, threshold)
        i += start
        yield (i[i < j], j[i < j]) if same else (i, j)


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def tile_links(ids_a: np.ndarray, a: np.ndarray, ids_b: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs between two tiles of vectors (doubles)."""
    na, nb = norms(a), norms(b)
    out = []
    for i, j in tile_candidates(quantise(a / na[:, None]), quantise(b / nb[:, None]), threshold, same):
        cosine = np.einsum("ij,ij->i", a[i], b[j]) / (na[i] * nb[j])
        out.append((ids_a[i[cosine >= threshold]], ids_b[j[cosine >= threshold]]))
    return np.concatenate([x for x, _ in out] or [ids_a[:0]]), np.concatenate([y for _, y in out] or [ids_b[:0]])


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = 0.98, tile: int = TILE) -> DataFrame:
    """(id, n_links, component_id, kept) for every row.

    Rows of equal, non-null label link at cosine >= ``threshold`` in double precision. Vectors that
    are null, empty, zero, or hold a null or non-finite component link with nothing, nor do vectors
    of different length, nor rows without an id. Ids are whole numbers; others raise. Repeated rows link like other equal vectors. An empty table gives an empty
    table; other columns are ignored.

    The least projection on a fixed direction orders a label's vectors; unit vectors within the
    threshold lie within sqrt(2 - 2 * threshold) there, so tiles further apart are not paired. Vectors
    whose squares doubles cannot hold are divided by their largest component first.
    """
    x = F.col("v")
    largest = F.array_max(F.transform(x, F.abs))
    rows = cut(
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
        .withColumn("usable", F.coalesce(
            F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size(x) > 0) & F.exists(x, lambda c: c != 0)
            & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))), F.lit(False)))
        .withColumn("key", F.when(F.col("usable"), F.sha2(F.concat_ws(",", F.col("label").cast("string"), F.transform(x, lambda c: c.cast("string"))), 256)))
        .withColumn("v", F.when(F.col("usable") & ((largest < 1e-100) | (largest > 1e100)), F.transform(x, lambda c: c / largest)).otherwise(x))
    )
    nodes = rows.where("usable").groupBy("key").agg(
        F.min("id").alias("node"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("v").alias("v")
    )
    nodes = cut(_tiled(nodes, tile))
    found = cut(_linked(nodes, _tile_pairs(nodes, threshold), threshold))
    near = found.groupBy("node").agg(F.sum("near").alias("near"))
    classes = connected_components(found.select("node", "root"))
    named = nodes.select("key", "node", "copies").join(near, "node", "left").join(classes, "node", "left").select(
        "key", (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id")
    )
    out = rows.select("id", "key").join(cut(named), "key", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))


def _tiled(nodes: DataFrame, tile: int) -> DataFrame:
    """Deal each label's vectors, in order of a projection, to tiles of about ``tile`` rows.

    Tiles are ranges of (label, length, projection) rows: Spark's range partitions, each of which
    is cut at label and length. A partition holds at most a few times the mean.
    """
    n = nodes.count()
    parts = max(1, -(-n // tile))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c))
    signs = F.aggregate(F.transform("v", lambda c, i: F.when(F.pmod(F.xxhash64(i), F.lit(2)) == 0, c).otherwise(-c)), F.lit(0.0), lambda s, c: s + c)
    placed = nodes.withColumn("at", signs / F.sqrt(F.size("v")) / norm).withColumn("length", F.size("v"))
    return placed.repartitionByRange(parts, "label", "length", "at", "node").withColumn("part", F.spark_partition_id())


def _tile_pairs(nodes: DataFrame, threshold: float) -> DataFrame:
    tiles = cut(nodes.groupBy("label", "length", "part").agg(F.min("at").alias("low"), F.max("at").alias("high")))
    other = tiles.select(F.col("label"), F.col("length"), F.col("part").alias("part_b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"))
    gap = float(np.sqrt(2 - 2 * threshold)) + 1e-6
    return tiles.join(other, ["label", "length"]).where(
        (F.col("part") <= F.col("part_b")) & (F.col("low_b") - F.col("high") <= gap) & (F.col("low") - F.col("high_b") <= gap)
    ).select("label", "length", F.col("part").alias("part_a"), "part_b")


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least reachable index of each of n nodes over the pairs (i, j)."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


TILES = ("label", "length", "part_a", "part_b")


def _matrix(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).combine_chunks().flatten().to_numpy().reshape(len(table), -1)


def _in_order(table: pa.Table) -> pa.Table:
    return table.take(pa.compute.sort_indices(table, [("node", "ascending")]))


def _quantised(nodes: DataFrame) -> DataFrame:
    """(label, length, part, node, codes, scale, near, rest) of nodes."""
    keep = nodes.select("label", "length", "part", "node", "v")
    kinds = ", ".join(f"{c} {keep.schema[c].dataType.simpleString()}" for c in keep.columns[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.asarray(pa.compute.list_value_length(batch.column("v")))
            for n in np.unique(lengths):
                part = batch.filter(pa.array(lengths == n))
                v = part.column("v").flatten().to_numpy().reshape(part.num_rows, -1)
                codes, *bounds = quantise(v / norms(v)[:, None])
                columns = [*part.columns[:-1], pa.array([c.tobytes() for c in codes], pa.binary()), *map(pa.array, bounds)]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names[:-1], "codes", "scale", "near", "rest"])

    return keep.mapInArrow(run, kinds + ", codes binary, scale double, near double, rest double")


def _linked(nodes: DataFrame, tile_pairs: DataFrame, threshold: float) -> DataFrame:
    """(node, near, root) of each pair of tiles: for a node with links there, how many vectors it
    links with, copies counted, and the least node it reaches there. A group is the rows of two
    tiles; it gives a row per node, not per link, so a dense group of near copies stays small.

    First the codes of both tiles meet, and name the nodes with a pair that may link; then the
    doubles of just these.
    """
    sides = tile_pairs.select(*TILES, F.explode(F.when(
        F.col("part_a") == F.col("part_b"), F.array("part_a")).otherwise(F.array("part_a", "part_b"))).alias("part"))
    place = ", ".join(f"{c} {tile_pairs.schema[c].dataType.simpleString()}" for c in TILES)

    def screen(table: pa.Table) -> pa.Table:
        table = _in_order(table)
        ids, part, scale, near, rest = (table.column(c).to_numpy() for c in ("node", "part", "scale", "near", "rest"))
        codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), np.int8).reshape(len(ids), -1)
        a, b = table.column("part_a")[0].as_py(), table.column("part_b")[0].as_py()
        left, right = (tuple(x[part == p] for x in (codes, scale, near, rest)) for p in (a, b))
        at_a, at_b, maybe = np.flatnonzero(part == a), np.flatnonzero(part == b), np.zeros(len(ids), bool)
        for i, j in tile_candidates(left, right, threshold, a == b):
            maybe[at_a[i]] = maybe[at_b[j]] = True
        return table.filter(pa.array(maybe)).select([*TILES, "part", "node"])

    work = _quantised(nodes).join(sides, ["label", "length", "part"])
    due = work.groupBy(*TILES).applyInArrow(screen, f"{place}, part int, node long")

    def run(table: pa.Table) -> pa.Table:
        table = _in_order(table)
        ids, copies, part = (table.column(c).to_numpy() for c in ("node", "copies", "part"))
        flat = _matrix(table, "v")
        a, b = table.column("part_a")[0].as_py(), table.column("part_b")[0].as_py()
        at = np.arange(len(ids))
        i, j = tile_links(at[part == a], flat[part == a], at[part == b], flat[part == b], threshold, a == b)
        near = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
        some = np.flatnonzero(near)
        return pa.table({"node": ids[some], "near": near[some].astype(np.int64), "root": ids[local_roots(len(ids), i, j)[some]]})

    exact = due.join(nodes.select("label", "length", "part", "node", "copies", "v"), ["label", "length", "part", "node"])
    return exact.groupBy(*TILES).applyInArrow(run, "node long, near long, root long")
