"""Cross-tokenizer alignment with whitespace anchors.

A text is tokenised whole by a byte-level BPE (A) and by a piece model with byte fallback (B). Where
both begin a token that starts with a space at one byte, both ended one there: such anchors cut the
text into windows of token ids, which repeat like words do. A window's alignment is worked out once
and remembered by its ids. What a pair of ids counts in the whole corpus goes back to the documents that
hold it.

Tasks write documents in slices of a few megabytes of text. Pairs of ids are numbered within a slice, and
a document keeps the numbers of its pairs, packed, so that tables of distinct pairs are counted and joined.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, shared_folder, text_slices, tidy

#: Bytes of text that are written as one slice, and windows, and bytes of their ids, that a task remembers.
SLICE_TEXT, MOST_WINDOWS, MOST_BYTES = 8 << 20, 400_000, 32 << 20

# The pattern of A's pre-tokenizer, and what no version of Unicode classes otherwise: texts of
# these characters alone, without very long blanks, may be cut by another implementation of the pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NOT_PLAIN = "[^\t-\r\x20-\x7e\xa0-ʯ]|[\t-\r \xa0]{10000}"


def byte_letters() -> dict[str, int]:
    """The letters of byte-level vocabularies: a printing byte is itself, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def merges_by_rank(a_json: str) -> dict[bytes, int] | None:
    """Ranks of A's tokens, if its merges are in the order of the tokens they make.

    Then a pair is the only one that makes its token when its turn comes, so that merging by the rank of
    the result, as tiktoken does, gives A's tokens. None if that is not so, or A cuts texts otherwise.
    """
    model = json.loads(a_json)
    cut_by, vocab = model.get("pre_tokenizer") or {}, model["model"]["vocab"]
    if model.get("normalizer") or cut_by.get("type") != "ByteLevel" or cut_by.get("add_prefix_space") or not cut_by.get("use_regex") or model["model"].get("ignore_merges"):
        return None
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
    letters, special = byte_letters(), {t["content"] for t in model.get("added_tokens", ())}
    made = [vocab.get(p + q, -1) for p, q in merges]
    rest = {v for k, v in vocab.items() if k not in special} - set(made)
    if made != [*range(256, 256 + len(made))] or rest != {*range(256)} or any(max(vocab[p], vocab[q]) >= m for (p, q), m in zip(merges, made)):
        return None
    return {bytes(letters[c] for c in k): v for k, v in vocab.items() if k not in special}


class Coder:
    """Both tokenizers, with the bytes of every token. Ids must be below 65,535."""

    def __init__(self, a_json: str, b_model: bytes, ranks: dict[bytes, int] | None):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if ranks else None
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letters = byte_letters()
        names = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.a_bytes[i] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
        piece = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(piece)]
        self.a_size, self.b_size = (np.array([*map(len, x)], np.int64) for x in (self.a_bytes, self.b_bytes))
        self.a_mark, self.b_mark = (np.array([x.startswith(b" ") for x in y]) for y in (self.a_bytes, self.b_bytes))
        self.odd = re.compile(NOT_PLAIN)
        #: An id and what follows it in the text of groups, at 4 * id + the number of the mark.
        self.shown = [f"{i}{mark}" for i in range(max(len(self.a_bytes), len(self.b_bytes))) for mark in ",|;\n"]

    def encode_a(self, text: str) -> list[int]:
        if self.fast is None or self.odd.search(text):
            return self.a.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of A and B of each text; none where the tokens of either do not spell a space and the text."""
        for text, b in zip(texts, self.b.encode(texts, num_threads=1)):
            raw = (" " + text).encode()
            a = self.encode_a(" " + text) if text else []
            spelt = a and b"".join(map(self.b_bytes.__getitem__, b)) == raw and b"".join(map(self.a_bytes.__getitem__, a)) == raw
            yield (a, b) if spelt else ([], [])


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each range, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Windows:
    """The windows that a task remembers by their ids: their groups as text, and their links as numbers of pairs of ids."""

    def __init__(self, coder: Coder):
        self.coder, self.number, self.held = coder, {}, 0
        self.groups: list[str] = []
        self.pair: dict[int, int] = {}
        self.n_groups, self.first, self.links = np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64)

    def full(self) -> bool:
        return len(self.number) > MOST_WINDOWS or self.held > MOST_BYTES

    def numbers(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first token of A, number) of each window of texts one after the other, all spelt alike by both."""
        c = self.coder
        ends_a, ends_b = np.cumsum(c.a_size[a]), np.cumsum(c.b_size[b])
        starts_a, starts_b = ends_a - c.a_size[a], ends_b - c.b_size[b]
        mine = np.flatnonzero(c.a_mark[a])
        there = np.searchsorted(starts_b, starts_a[mine])
        there[there == len(b)] = 0
        held = (starts_b[there] == starts_a[mine]) & c.b_mark[b[there]]  # every text begins with a space, so with an anchor
        i, j = mine[held], there[held]
        n_a, n_b, w = np.diff(i, append=len(a)), np.diff(j, append=len(b)), np.arange(len(i))
        packed = np.full(len(a) + len(b) + len(i), 65535, np.uint16)  # A's ids, a mark, and B's ids of each window
        packed[np.arange(len(a)) + np.repeat(j + w, n_a)] = a
        packed[np.arange(len(b)) + np.repeat(i + n_a + w + 1, n_b)] = b
        raw, at = packed.tobytes(), [*(2 * (i + j + w)).tolist(), 2 * len(packed)]
        keys = [raw[x:y] for x, y in zip(at, at[1:])]
        known = self.number
        fresh: dict[bytes, int] = {}
        for k, key in enumerate(keys):
            if key not in known:
                fresh.setdefault(key, k)
        if fresh:
            new = np.fromiter(fresh.values(), np.int64, len(fresh))
            self._align(a[_ranges(i[new], n_a[new])], b[_ranges(j[new], n_b[new])], n_a[new], n_b[new])
            known.update(zip(fresh, range(len(known), len(known) + len(fresh))))
            self.held += sum(map(len, fresh))
        return i, np.fromiter(map(known.__getitem__, keys), np.int64, len(keys))

    def _align(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> None:
        """Remember the alignment of windows, given one after the other."""
        c = self.coder
        ends_a, ends_b = np.cumsum(c.a_size[a]), np.cumsum(c.b_size[b])
        first = np.searchsorted(ends_b, ends_a - c.a_size[a], "right")  # B's tokens that share a byte with each of A's
        many = np.searchsorted(ends_b, ends_a, "left") - first + 1
        codes = np.repeat(a.astype(np.int64) << 16, many) | b[_ranges(first, many)]
        last_a, last_b = np.cumsum(n_a) - 1, np.cumsum(n_b) - 1
        cut_a, cut_b = np.isin(ends_a, ends_b, assume_unique=True), np.isin(ends_b, ends_a, assume_unique=True)
        edge = np.zeros(len(b), bool)
        edge[last_b] = True
        marks_a, marks_b = np.where(cut_a, 1, 0), np.where(edge, 3, np.where(cut_b, 2, 0))
        sizes_a, sizes_b = (np.diff(np.flatnonzero(x), prepend=-1) for x in (cut_a, cut_b))  # tokens of each group
        shown = np.zeros(len(a) + len(b), np.int64)
        shown[np.arange(len(a)) + np.repeat(np.cumsum(sizes_b) - sizes_b, sizes_a)] = 4 * a.astype(np.int64) + marks_a
        shown[np.arange(len(b)) + np.repeat(np.cumsum(sizes_a), sizes_b)] = 4 * b.astype(np.int64) + marks_b
        self.groups += "".join(map(c.shown.__getitem__, shown.tolist())).split("\n")[:-1]
        total = np.concatenate([[0], np.cumsum(many)])
        links = total[last_a + 1] - total[last_a + 1 - n_a]
        pair, numbers = self.pair, []
        for code in codes.tolist():
            numbers.append(pair.setdefault(code, len(pair)))
        passed = np.concatenate([[0], np.cumsum(cut_a)])
        self.n_groups = np.concatenate([self.n_groups, passed[last_a + 1] - passed[last_a + 1 - n_a]])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(links)])
        self.links = np.concatenate([self.links, np.array(numbers, np.int64)])


def packed_counts(numbers: np.ndarray) -> bytes:
    """Distinct numbers and how often each occurs, in few bytes."""
    distinct, times = np.unique(numbers, return_counts=True)
    both = np.concatenate([np.diff(distinct, prepend=0), times]).astype("<u4")
    return zlib.compress(both.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked_counts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


FIELDS = pa.schema([
    ("kind", pa.string()), ("slice", pa.string()), ("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("groups_sha256", pa.string()), ("groups", pa.string()), ("pairs", pa.binary()), ("number", pa.int32()), ("pair", pa.int64()), ("n", pa.int64()),
])
SCHEMA = "kind string, slice string, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, pairs binary, number int, pair long, n long"


def _rows(kind: str, name: str, size: int, **columns) -> pa.RecordBatch:
    columns |= {"kind": [kind] * size, "slice": [name] * size}
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in FIELDS], schema=FIELDS)


def _slices(coder: Coder, batches: Iterator[pa.RecordBatch], keep_groups: bool) -> Iterator[pa.RecordBatch]:
    """Rows of documents, and after those of a slice of the pairs of ids that they hold."""
    windows, name, size, counts = Windows(coder), uuid.uuid4().hex, 0, np.zeros(0, np.int64)

    def pairs() -> Iterator[pa.RecordBatch]:
        some = np.flatnonzero(counts)
        codes = np.fromiter(windows.pair, np.int64, len(windows.pair))
        for at in range(0, len(some), 50_000):
            part = some[at : at + 50_000]
            yield _rows("pair", name, len(part), number=part.astype(np.int32), pair=codes[part], n=counts[part])

    for batch in batches:
        for part in text_slices(batch, "text", 1 << 20):
            texts = [t or "" for t in part.column("text").to_pylist()]
            ids = [*coder.encode(texts)]
            n_a, n_b = (np.array([len(x[k]) for x in ids], np.int64) for k in (0, 1))
            a, b = (np.fromiter((i for x in ids for i in x[k]), np.uint16, int(n.sum())) for k, n in ((0, n_a), (1, n_b)))
            starts, numbers = windows.numbers(a, b) if len(a) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            edges = np.searchsorted(starts, np.concatenate([[0], np.cumsum(n_a)]))  # windows of each text
            links = windows.first[numbers + 1] - windows.first[numbers]
            flat = windows.links[_ranges(windows.first[numbers], links)]
            counted = np.bincount(flat, minlength=len(windows.pair))
            counted[: len(counts)] += counts
            counts = counted
            seen, passed = np.concatenate([[0], np.cumsum(links)]), np.concatenate([[0], np.cumsum(windows.n_groups[numbers])])
            shown = [*map(windows.groups.__getitem__, numbers.tolist())]
            groups = [";".join(shown[x:y]) for x, y in zip(edges, edges[1:])]
            yield _rows("document", name, len(texts), id=part.column("id"), n_a=n_a, n_b=n_b, n_groups=np.diff(passed[edges]), n_links=np.diff(seen[edges]),
                        groups_sha256=[hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups], **({"groups": groups} if keep_groups else {}),
                        pairs=[packed_counts(flat[x:y]) for x, y in zip(seen[edges], seen[edges[1:]])])
            size += sum(map(len, texts))
            if size >= SLICE_TEXT:
                yield from pairs()
                if windows.full():
                    windows = Windows(coder)
                name, size, counts = uuid.uuid4().hex, 0, np.zeros(len(windows.pair), np.int64)
    yield from pairs()


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pair, count, best) of the pairs (pair, n) of slices: links that hold a pair of ids, and whether no pair of its B id has more."""
    counts = cut(pairs.groupBy("pair").agg(F.sum("n").alias("count")))
    b = F.col("pair").bitwiseAND(F.lit(65535))
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    return counts.withColumn("b", b).join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))


def align(docs: DataFrame, a_json: str, b_model: bytes, id_col: str = "doc_id", text_col: str = "text", keep_groups: bool = False) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups) of every row of ``docs``.

    ``a_json`` and ``b_model`` are the contents of the tokenizers' files. Tokens of A (of a space and the
    text) and of B (which adds the space) are cut into groups where both end; a link is a pair of tokens
    that share a byte. count_sum adds, over a row's links, how many links of the whole table hold the same
    pair of ids; n_best counts links whose pair no other of its B id exceeds. groups is text like
    ``a1,a2|b1;a3|b2`` with ``keep_groups``, else null (empty without tokens); its digest is always there. A null or empty text, or
    one that either tokenizer does not spell again, has zeros and an empty digest. Ids may be null or
    repeat: each row is a document of its own, in which a repeated row's links count again.
    """
    spark = docs.sparkSession
    models = spark.sparkContext.broadcast((a_json, b_model, merges_by_rank(a_json)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _slices(Coder(*models.value), batches, keep_groups)

    folder = shared_folder(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), SCHEMA)
    rows.write.option("compression", "zstd").partitionBy("kind").parquet(folder)
    stored = spark.read.schema(SCHEMA).parquet(folder)
    pairs = stored.where("kind = 'pair'").select(F.col("slice").alias("place"), "number", "pair", "n")
    of_slice = pairs.join(pair_counts(pairs), "pair").select("place", "number", "count", "best")

    def total(documents: pa.Table, found: pa.Table) -> pa.Table:
        number = found.column("number").to_numpy()
        count, best = np.zeros(number.max(initial=-1) + 1, np.int64), np.zeros(number.max(initial=-1) + 1, np.int64)
        count[number], best[number] = found.column("count").to_numpy(), found.column("best").to_numpy()
        sums: tuple[list[int], list[int]] = ([], [])
        for data in documents.column("pairs").to_pylist():
            at, times = unpacked_counts(data)
            sums[0].append(int(best[at] @ times)), sums[1].append(int(count[at] @ times))
        kept = [documents.column(c) for c in OUT[:5]]
        return pa.table([*kept, *(pa.array(x, pa.int64()) for x in sums), *(documents.column(c) for c in OUT[7:])], names=[*OUT])

    documents = stored.where("kind = 'document'").select("slice", *OUT[:5], *OUT[7:], "pairs")
    schema = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"
    return documents.groupBy("slice").cogroup(of_slice.groupBy("place")).applyInArrow(total, schema)


OUT = ("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups")
