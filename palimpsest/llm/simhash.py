"""SimHash near-duplicates found by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all variants within half the radius. Two fingerprints within the
radius share a variant, so one shuffle on variants brings each linked pair together. A variant's
bucket holds only fingerprints within half the radius of it, 65 for radius 2, whatever the input:
no bucket can grow, and copies were merged before.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, dealt_anew, text_slices, tidy
from .components import connected_components

#: Fingerprints whose balls one task emits: they are dealt anew before, as aggregation leaves them in few partitions.
BALLS = 16_384

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _bit_counts(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """For each of n owners, in how many of its hashes each bit (0 is the lowest) is set."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    out = np.zeros((n, 64), np.int64)
    if len(starts):
        out[owner[starts]] = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    return out


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Fingerprint of one text by the definition in :func:`fingerprints`."""
    words = text.translate(_LOWER).split()
    digest = xxhash.xxh64_intdigest
    total, counts = 0, np.zeros(64, np.int64)
    m = max(1, len(words) - shingle + 1) if words else 0
    for a in range(0, m, 1 << 15):  # bounded arrays for texts of any length
        n = min(m, a + (1 << 15)) - a
        part = words[a : a + n + shingle - 1]
        if len(words) < shingle:
            grams = [b" ".join(part)]
        else:
            grams = map(b" ".join, zip(*(part[k : k + n] for k in range(shingle))))
        hashes = np.fromiter((digest(g, seed) for g in grams), np.uint64, n)
        counts += _bit_counts(hashes, np.zeros(n, np.int64), 1)[0]
        total += n
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """One row (id, fingerprint as signed long) per row of ``docs``.

    A-Z is lower-cased; words are runs of non-space; shingles of ``shingle`` words, repeats
    included, are joined by a space and hashed by XXH64; a bit is set where over half the hashes
    have it. Fewer words than a shingle: the whole sequence is the only shingle. A null, empty or
    blank text has fingerprint zero. Repeated rows and ids each give a row. Ids are of any type that
    can be ordered; null ids are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts = part.column("text").cast(pa.large_binary()).to_pylist()
                found = np.fromiter((fingerprint(t or b"", shingle, seed) for t in texts), np.uint64, len(texts))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(found.view(np.int64))], ["id", "fingerprint"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(tidy(run), f"id {rows.schema['id'].dataType.simpleString()}, fingerprint long")


def variants(fp: Column, radius: int, n_bits: int = 64) -> Column:
    """Array of all values within ``radius`` flipped bits of ``fp``, itself included."""
    masks = [0]
    for k in range(1, radius + 1):
        masks += [sum(1 << b for b in bits) for bits in combinations(range(n_bits), k)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    return F.transform(F.lit(signed) if len(signed) > 1 else F.array(F.lit(0)), lambda m: fp.bitwiseXOR(m.cast("long")))


def links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """All pairs (a < b) of the column ``fingerprint`` at 1 to ``radius`` differing bits, each once.

    ``distinct`` has each fingerprint once. An odd radius uses the larger half.
    """
    half = (radius + 1) // 2
    parts = -(-distinct.count() // BALLS) or 1
    balls = distinct.repartition(parts, "fingerprint").select(F.explode(variants(F.col("fingerprint"), half)).alias("variant"), "fingerprint")
    buckets = balls.groupBy("variant").agg(F.array_sort(F.collect_set("fingerprint")).alias("f")).where(F.size("f") > 1)
    pairs = (
        buckets.select("f", F.posexplode("f").alias("i", "a"))
        .select("a", F.explode(F.slice("f", F.col("i") + 2, F.size("f"))).alias("b"))
    )
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2) -> DataFrame:
    """(id, fingerprint, component_id, kept) for every row of ``docs``.

    Rows link when their fingerprints differ in at most ``radius`` bits; component_id is the
    smallest id reachable over links; a row is kept when it is the component's smallest id.
    Equal fingerprints are one node of the graph, so a group of copies costs one row. Rows whose
    id repeats share their class if their texts do; null ids never become a component's name.
    An empty table gives an empty table; extra columns are ignored.
    """
    marked = cut(fingerprints(docs, id_col, text_col))
    nodes = cut(marked.groupBy("fingerprint").agg(F.min("id").alias("least")))
    classes = connected_components(links(nodes.select("fingerprint"), radius)).withColumnRenamed("node", "fingerprint")
    grouped = cut(nodes.join(classes, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint")))
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = cut(dealt_anew(grouped, "component").join(dealt_anew(least, "component").drop("component"), "dealt").select("fingerprint", "component_id"))
    return marked.join(named, "fingerprint").select(
        "id", "fingerprint", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")
    )


def hex_fingerprint(fp: Column) -> Column:
    """16 lowercase hex digits of the unsigned value."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
