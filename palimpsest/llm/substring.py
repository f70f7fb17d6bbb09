"""Exact substring deduplication by prefix-partitioned suffix trees.

A window of ``WINDOW`` words is anchored at its least-hashed run of ``PREFIX`` words, which depends
on the window's words alone. Suffixes are taken at anchors, and partitioned by that run, their
prefix. A prefix found in one document only cannot begin a repeat. The other suffixes, with the
words before and after that their windows reach, go to groups of whole prefixes, packed by their counts. Each
group's suffix tree is read off its sorted suffixes and their common prefixes, and so is the tree of
what stands before them; nodes of both that are a window deep together are the repeats.
A prefix with too many suffixes for a group is lengthened, for each of its windows, to the whole
window, which is a deep node by itself; such nodes are counted by an aggregation, so no group of
copies ever meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, dealt_anew, span_hashes, text_bytes, text_slices, tidy, word_hashes, word_spans

WINDOW = 50
PREFIX = 10
#: Suffixes after which a group is full; each group is one subtree task of some tens of MB.
GROUP_SUFFIXES = 4_000
#: A prefix with more suffixes is lengthened to whole windows.
MOST_SUFFIXES = 20_000

_POSITION = np.uint64(28)


class Anchors:
    """Words of some texts, and the anchors of their windows: prefix, word, first and last window."""

    def __init__(self, column: pa.Array, window: int, prefix: int):
        self.raw, offsets = text_bytes(column)
        self.starts, self.ends, row = word_spans(self.raw, offsets)
        self.first = np.searchsorted(row, np.arange(len(column) + 1))  # first word of each row
        n = len(self.starts)
        whole = self.first[row + 1] - np.arange(n) >= window if n else np.zeros(0, bool)  # a window starts here
        at = np.flatnonzero(whole)
        if not len(at):
            self.prefix = self.anchor = self.low = self.high = self.row = np.zeros(0, np.int64)
            return
        values = word_hashes(self.raw, self.starts, self.ends)
        m = n - prefix + 1
        grams = span_hashes(values, np.arange(m), np.arange(m) + prefix, 0x2545F4914F6CDD1D)
        # least gram of each window, the leftmost on a tie: hash bits above, word number below
        least = (grams >> _POSITION << _POSITION) | np.arange(m, dtype=np.uint64)
        width, reach = 1, window - prefix + 1
        while 2 * width <= reach:
            least = np.minimum(least[:-width], least[width:]) if len(least) > width else least
            width *= 2
        least = np.minimum(least[at], least[at + reach - width])
        anchor = (least & np.uint64((1 << 28) - 1)).astype(np.int64)
        new = np.flatnonzero(np.diff(anchor, prepend=-1) | (np.diff(at, prepend=-2) > 1))
        self.anchor, self.low, self.high = anchor[new], at[new], at[np.append(new[1:], len(at)) - 1]
        self.prefix, self.row = grams[self.anchor].view(np.int64), row[self.low]


def _anchors(docs: DataFrame, window: int, prefix: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                found = Anchors(part.column("text"), window, prefix)
                to = pa.array(found.row)
                yield pa.RecordBatch.from_arrays([pa.array(found.prefix), part.column("id").take(to), part.column("h").take(to)], ["prefix", "id", "h"])

    return docs.mapInArrow(tidy(run), "prefix long, id long, h long")


def _suffixes(marked: DataFrame, window: int, prefix: int, column: str, whole: bool) -> DataFrame:
    """Suffixes whose prefix is in the array ``column`` of (prefix, part): words low to high + window with how many of
    them stand before the anchor; or, with ``whole``, a digest of each window of theirs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                found = Anchors(part.column("text"), window, prefix)
                wanted = part.column(column)
                size = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(wanted), 0))
                prefixes, groups = wanted.flatten().flatten()
                group = dict(zip(zip(np.repeat(np.arange(len(size)), size).tolist(), prefixes.to_pylist()), groups.to_pylist()))
                to_group = [group.get(p, -1) for p in zip(found.row.tolist(), found.prefix.tolist())]
                key = np.array(to_group, np.int64)
                keep = key >= 0
                low, high, anchor, row, key = (x[keep] for x in (found.low, found.high, found.anchor, found.row, key))
                if whole:
                    times = high - low + 1
                    start = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    row, low, high = np.repeat(row, times), start, start
                text = [b" ".join(bytes(words).split()) for words in (
                    found.raw[found.starts[a] : found.ends[b + window - 1]] for a, b in zip(low.tolist(), high.tolist()))]
                to, start = pa.array(row), pa.array(low - found.first[row])
                ids = [part.column("id").take(to), part.column("h").take(to), start]
                if whole:
                    digests = pa.array([blake2b(t, digest_size=16).digest() for t in text], pa.binary())
                    yield pa.RecordBatch.from_arrays([*ids, digests], ["id", "h", "start", "digest"])
                else:
                    yield pa.RecordBatch.from_arrays(
                        [*ids, pa.array(key), pa.array(anchor - low), pa.array(text, pa.binary())], ["id", "h", "start", "part", "before", "words"])

    return marked.mapInArrow(tidy(run), "id long, h long, start long, " + ("digest binary" if whole else "part long, before long, words binary"))


def _nodes(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in lexicographic order, and how many leading columns each shares with the one before.

    This is the suffix array and its common prefixes: a node at depth d holds the rows between
    neighbours that share fewer than d columns.
    """
    order = np.lexsort(matrix.T[::-1])
    differs = matrix[order[1:]] != matrix[order[:-1]]
    shared = np.where(differs.any(1), differs.argmax(1), matrix.shape[1])
    return order, np.concatenate([[-1], shared])


def subtree_repeats(ids: np.ndarray, before: np.ndarray, column: pa.Array, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(suffix, window start relative to its first word) of each window that a smaller id has too.

    ``column`` holds each suffix's words with those before its anchor, ``before`` how many these are.
    """
    raw, offsets = text_bytes(column)
    starts, ends, row = word_spans(raw, offsets)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 2
    lengths = np.append(0, np.cumsum(ends - starts)).astype(np.int32)
    words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(lengths), pa.py_buffer(raw[raw != 0x20])])
    code = words.dictionary_encode().indices.to_numpy().astype(np.int32)
    first = np.searchsorted(row, np.arange(len(column) + 1))
    place = np.arange(len(starts)) - first[row] - before[row]  # of each word, from the anchor
    after = np.diff(first) - before
    right = np.full((len(column), window), -1, np.int32)
    use = (place >= 0) & (place < window)
    right[row[use], place[use]] = code[use]
    left = np.full((len(column), max(int(before.max()), 1)), -1, np.int32)
    use = place < 0
    left[row[use], -1 - place[use]] = code[use]
    (order_r, shared_r), (order_l, shared_l) = _nodes(right), _nodes(left)
    found = []
    node_r, node_l = np.empty((2, len(column)), np.int64)
    for back in range(left.shape[1] + 1):  # windows that start so many words before the anchor
        own = np.flatnonzero((before >= back) & (after >= window - back))
        if len(own) < 2:
            continue
        node_r[order_r] = np.cumsum(shared_r < window - back)
        node_l[order_l] = np.cumsum(shared_l < back)
        key = node_r[own] * (len(column) + 1) + node_l[own]
        order = np.lexsort((ids[own], key))
        ranked, key = own[order], key[order]
        head = np.flatnonzero(np.diff(key, prepend=-1))
        least = np.repeat(ids[ranked[head]], np.diff(np.append(head, len(key))))
        hit = ranked[ids[ranked] > least]
        found.append((hit, before[hit] - back))
    if not found:
        return (np.zeros(0, np.int64),) * 2
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _runs(suffix: np.ndarray, start: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffix, start, end) of the words that neighbouring windows cover together."""
    order = np.lexsort((start, suffix))
    suffix, start = suffix[order], start[order]
    new = np.flatnonzero((np.diff(suffix, prepend=-1) != 0) | (np.diff(start, prepend=-2) != 1))
    last = np.append(new[1:], len(start)) - 1 if len(start) else new
    return suffix[new], start[new], start[last] + window


def _packed(shared: DataFrame, group: int = GROUP_SUFFIXES) -> DataFrame:
    """``shared`` (prefix, long, n) with ``part``, the group of whole prefixes that each goes to.

    Prefixes in order are packed by their counted suffixes: a group begins every ``group`` suffixes, so it holds
    at most so many and those of its last prefix. Running sums go by ranges with offsets, not through one task.
    """
    parts = max(1, shared.sparkSession.sparkContext.defaultParallelism)
    dealt = cut(shared.repartitionByRange(parts, "prefix").withColumn("range", F.spark_partition_id()))
    before = dealt.groupBy("range").agg(F.sum("n").alias("sum")).withColumn(
        "before", F.coalesce(F.sum("sum").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    own = F.sum("n").over(Window.partitionBy("range").orderBy("prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    return dealt.withColumn("own", own).join(F.broadcast(before.select("range", "before")), "range").select(
        "prefix", "long", F.floor((F.col("own") + F.col("before")) / group).cast("long").alias("part"))


def repeats(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, most: int = MOST_SUFFIXES) -> DataFrame:
    """(id, h, start, end): runs of words of the row (id, h) that windows with an equal one in a row
    of smaller id cover. ``docs`` has id, h (a hash of the text) and text. Runs may overlap.
    """
    anchors = _anchors(docs, window, prefix)
    shared = cut(anchors.groupBy("prefix").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n"))
                 .where("low < high").select("prefix", (F.col("n") > most).alias("long"), "n"))
    some_long = not shared.where("long").isEmpty()
    packed = _packed(shared.where("NOT long")).unionByName(shared.where("long").select("prefix", "long", F.lit(0).cast("long").alias("part")))
    place = F.struct("prefix", "part")
    marks = anchors.join(packed, "prefix").groupBy("id", "h").agg(F.collect_set(F.when(~F.col("long"), place)).alias("short"), F.collect_set(F.when(F.col("long"), place)).alias("long"))
    marked = docs.join(marks, ["id", "h"])
    suffixes = _suffixes(marked.select("id", "h", "text", "short"), window, prefix, "short", False)

    def subtree(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        words = table.column("words").combine_chunks().cast(pa.large_binary()).cast(pa.large_string())
        suffix, start, end = _runs(*subtree_repeats(ids, table.column("before").to_numpy(), words, window), window)
        base = table.column("start").to_numpy()[suffix]
        return pa.table({"id": ids[suffix], "h": table.column("h").to_numpy()[suffix], "start": base + start, "end": base + end})

    found = suffixes.groupBy("part").applyInArrow(subtree, "id long, h long, start long, end long")
    if some_long:
        windows = _suffixes(marked.select("id", "h", "text", "long"), window, prefix, "long", True)
        least = dealt_anew(windows.groupBy("digest").agg(F.min("id").alias("low")), "digest").drop("digest")
        hits = dealt_anew(windows, "digest").join(least, "dealt").where(F.col("id") > F.col("low"))
        found = found.unionByName(hits.select("id", "h", "start", (F.col("start") + window).alias("end")))
    return found


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, prefix: int = PREFIX,
                most: int = MOST_SUFFIXES) -> DataFrame:
    """(id, n_words, n_removed, kept_text) for every row of ``docs``.

    Each word is removed that some window of ``window`` words covers whose words also start in a
    row of smaller id, judged on the input. Kept words are joined by one space. Null and empty texts
    have no words; texts shorter than a window lose nothing. Rows of one id do not remove each
    other's words; a null id counts as larger than any. Ids are whole numbers; others raise. Windows of one long prefix are compared by
    128-bit digests, all others word by word. Other columns are ignored.
    """
    most_id = (1 << 63) - 1
    rows = docs.select(F.col(id_col).cast("long").alias("own"), F.col(text_col).alias("text"))
    rows = rows.select("own", F.coalesce("own", F.lit(most_id)).alias("id"), F.xxhash64("text").alias("h"), "text")
    runs = repeats(rows.select("id", "h", "text"), window, prefix, most)
    # a set, as rows that share id and text find the same runs, however many they are
    runs = runs.groupBy("id", "h").agg(F.collect_set(F.struct("start", "end")).alias("runs"))
    joined = rows.join(runs, ["id", "h"], "left").select("own", "text", F.col("runs.start").alias("start"), F.col("runs.end").alias("end"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                n, removed, kept = [], [], []
                for text, start, end in zip(*(part.column(c).to_pylist() for c in ("text", "start", "end"))):
                    words = (text or "").encode().split()
                    n.append(len(words))
                    if start:
                        depth = np.zeros(len(words) + 1, np.int64)
                        np.add.at(depth, start, 1)
                        np.add.at(depth, end, -1)
                        words = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]
                    removed.append(n[-1] - len(words))
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [part.column("own"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    ["id", "n_words", "n_removed", "kept_text"])

    return joined.mapInArrow(tidy(run), "id long, n_words long, n_removed long, kept_text string")
