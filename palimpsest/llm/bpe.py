"""Byte-level BPE encoding and decoding by DuckDB recursive queries inside each partition.

A task splits its texts into pieces, and encodes the distinct pieces it has not met: token-position
rows join the merge table, each word's leftmost pair of least rank is contracted, and the query
recurs until no pair is left. Decoding joins token ids to their bytes and aggregates them in order.
Texts never meet across rows, so there is no shuffle.

Two exact properties keep this fast for words of any length. No merge crosses two neighbouring bytes
that stand together in no token, so a word falls apart there into units. And where no pair with the
made token ranks lower than it, leftmost contraction goes on with the other occurrences of the pair;
words not done after some single contractions go on by rounds that take them all.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import types
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import text_bytes, text_slices, tidy

#: Bytes of text encoded at once.
ENCODE_BYTES = 2 << 20
#: Bytes of remembered pieces and ids; when there are more, all are forgotten but the vocabulary's own.
REMEMBERED_BYTES = 32 << 20
#: Rows that one recursive query starts from (a longer unit is taken alone), and all rows of its rounds.
QUERY_ROWS, ROUND_ROWS = 200_000, 3_200_000
#: DuckDB's memory in a task, in MB; a single very long unit or text gets more, by its length. Nothing is spilled.
MEMORY_MB = 160

#: The leftmost least pair of each word a round; rows know their neighbours, so that no round sorts.
_CONTRACT_ONE = """
WITH RECURSIVE s(w, step, pos, tok, before, after, after_tok, rank) AS (
    SELECT w, 0, pos, tok, before, after, after_tok, rank FROM (
        SELECT *, lag(pos) OVER word AS before, lead(pos) OVER word AS after, lead(tok) OVER word AS after_tok FROM start WINDOW word AS (PARTITION BY w ORDER BY pos)
    ) LEFT JOIN merges m ON m.a = tok AND m.b = after_tok
  UNION ALL (
    WITH hits AS (SELECT w, min((rank::BIGINT << 32) | pos) AS hit FROM s WHERE rank IS NOT NULL AND step < {rounds} GROUP BY w),
    least AS (SELECT w, (hit >> 32)::INT AS made, (hit & 4294967295)::INT AS head FROM hits),
    pair AS (SELECT s.w, made, head, s.pos AS gone, s.after, s.after_tok FROM least l JOIN s ON s.w = l.w AND s.before = l.head),
    n AS (
        SELECT s.w, step, s.pos, s.pos = head AS is_head, s.pos = head OR s.after = head AS changed, rank,
            CASE WHEN is_head THEN made ELSE tok END AS tok, CASE WHEN s.before = gone THEN head ELSE s.before END AS before,
            CASE WHEN is_head THEN p.after ELSE s.after END AS after, CASE WHEN is_head THEN p.after_tok WHEN s.after = head THEN made ELSE s.after_tok END AS after_tok
        FROM s JOIN pair p ON p.w = s.w WHERE s.pos <> gone)
    SELECT n.w, step + 1, pos, tok, before, after, after_tok, CASE WHEN changed THEN m.rank ELSE n.rank END
    FROM n LEFT JOIN merges m ON m.a = CASE WHEN changed THEN n.tok END AND m.b = n.after_tok)
)
SELECT w, step, pos, tok FROM s
"""
#: The same for all occurrences of the pair, by each token's number in its word.
_CONTRACT_ALL = """
WITH RECURSIVE s(w, step, pos, tok) AS (
    SELECT w, 0, pos, tok FROM start
  UNION ALL (
    WITH p AS (SELECT *, lead(tok) OVER word AS after, row_number() OVER word AS i FROM s WHERE step < {rounds} WINDOW word AS (PARTITION BY w ORDER BY pos)),
    ranked AS (SELECT p.*, m.rank, m.safe FROM p LEFT JOIN merges m ON m.a = p.tok AND m.b = p.after),
    least AS (SELECT w, min(rank) AS made FROM ranked WHERE rank IS NOT NULL GROUP BY w),
    live AS (SELECT r.*, made FROM ranked r JOIN least USING (w)),
    hits AS (SELECT w, i, made, safe, row_number() OVER (PARTITION BY w ORDER BY i) AS k FROM live WHERE rank = made),
    runs AS (SELECT w, i - k AS run, min(i) AS low FROM hits GROUP BY w, run),
    taken AS (SELECT h.w, i, made FROM hits h JOIN runs r ON r.w = h.w AND r.run = i - k WHERE (i - low) % 2 = 0 AND (safe OR k = 1)),
    ends AS (SELECT w, i, made FROM taken UNION ALL SELECT w, i + 1, NULL FROM taken)
    SELECT l.w, step + 1, pos, coalesce(e.made, tok) FROM live l LEFT JOIN ends e ON e.w = l.w AND e.i = l.i WHERE e.w IS NULL OR e.made IS NOT NULL)
)
SELECT w, step, pos, tok FROM s
"""

_DECODE = """
SELECT doc, array_to_string(list(v.latin ORDER BY pos), '') AS bytes FROM tokens JOIN vocabulary v USING (id) GROUP BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a .tiktoken file. A vocabulary is of fixed size, so tasks get it whole."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge_table(ranks: dict[bytes, int]) -> dict[str, np.ndarray]:
    """Every pair of tokens that makes a token: a, b, rank, and whether a round may take all its
    occurrences (safe), as no pair with the made token has a lower rank."""
    pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
    a, b, rank = np.array(pairs, np.int32).reshape(-1, 3).T.copy()
    least = np.full(max(ranks.values(), default=0) + 1, np.iinfo(np.int32).max)
    np.minimum.at(least, a, rank)
    np.minimum.at(least, b, rank)
    return {"a": a, "b": b, "rank": rank, "safe": least[rank] > rank}


def neighbours(ranks: dict[bytes, int]) -> np.ndarray:
    """Which two bytes stand together in some token."""
    beside = np.zeros((256, 256), bool)
    for token in ranks:
        raw = np.frombuffer(token, np.uint8)
        beside[raw[:-1], raw[1:]] = True
    return beside


def _process_memory() -> dict[str, tuple]:
    """What this Python process keeps from task to task, by vocabulary; a new process begins without it."""
    return vars(sys.modules.setdefault("_palimpsest_pieces", types.ModuleType("_palimpsest_pieces"))).setdefault("known", {})


class Codec:
    """The DuckDB tables of one vocabulary, and what has been encoded: pieces, in Arrow, and their
    ids, the sizes and starts of which are numpy arrays. With a ``name`` for the vocabulary, tasks of one
    process hand what they remember on to each other."""

    def __init__(self, ranks: dict[bytes, int], merges: dict[str, np.ndarray], pattern: str, name: str | None = None):
        self.name = name
        self.pattern = regex.compile(pattern)
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": f"{MEMORY_MB}MB", "temp_directory": "", "preserve_insertion_order": False})
        self._table("merges", **merges)
        self._table("vocabulary", id=np.array([*ranks.values()], np.int32), latin=[t.decode("latin-1") for t in ranks])
        self.beside = neighbours(ranks)
        self.byte_ids = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int32)
        whole = {t.decode(errors="replace"): r for t, r in ranks.items()}  # a replaced one stands for no piece that is valid
        whole = {t: r for t, r in whole.items() if "\ufffd" not in t}
        self.own = pa.array([*whole], pa.large_string()), np.array([*whole.values()], "<u4"), np.ones(len(whole), np.int64)
        self.pieces, self.ids, self.sizes = _process_memory().get(name, self.own)

    def _table(self, name: str, **columns) -> None:
        rows = pa.table({k: pa.array(v) for k, v in columns.items()})
        self.con.register("rows", rows)
        self.con.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM rows")
        self.con.unregister("rows")

    def close(self) -> None:
        self.con.close()
        if self.name is not None:
            _process_memory().clear()
            _process_memory()[self.name] = self.pieces, self.ids, self.sizes

    def _ask(self, query: str, size: int) -> dict[str, np.ndarray]:
        """The query's columns; DuckDB may use more memory for it where ``size`` rows of one unit or text need it."""
        needed = size * 1000 >> 20
        if needed > MEMORY_MB:
            self.con.execute(f"SET memory_limit = '{needed}MB'")
        try:
            return self.con.execute(query).fetchnumpy()
        finally:
            if needed > MEMORY_MB:
                self.con.execute(f"SET memory_limit = '{MEMORY_MB}MB'")

    def contract(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and how many each word has."""
        raw, offsets = text_bytes(words)
        starts, lengths = offsets[:-1], np.diff(offsets)
        new = np.ones(len(raw), bool)
        new[1:] = ~self.beside[raw[:-1], raw[1:]]
        new[starts[lengths > 0]] = True
        unit = (np.cumsum(new) - 1).astype(np.int32)
        size = np.bincount(unit)[unit]
        token = self.byte_ids[raw]
        place = np.flatnonzero(size > 1)
        token[place] = -1
        state = [unit[place], place.astype(np.int32), self.byte_ids[raw[place]]]
        query = _CONTRACT_ONE
        while len(state[0]):
            first = np.flatnonzero(np.diff(state[0], prepend=-1))  # of each unit
            batch = first // QUERY_ROWS
            cuts = [*first[np.flatnonzero(np.diff(batch, prepend=-1))].tolist(), len(state[0])]
            left = []
            for a, b in zip(cuts, cuts[1:]):
                self._table("start", w=state[0][a:b], pos=state[1][a:b], tok=state[2][a:b])
                rounds = max(1, min(16, ROUND_ROWS // (b - a)))
                w, step, pos, tok = self._ask(query.format(rounds=rounds), b - a).values()
                last = np.zeros(w.max() - w.min() + 1, np.int32)  # the round that left each unit as it is
                np.maximum.at(last, w - w.min(), step)
                now = step == last[w - w.min()]
                done = now & (step < rounds)
                token[pos[done]] = tok[done]
                more = np.flatnonzero(now & (step == rounds))
                more = more[np.argsort(pos[more])]
                left.append((w[more], pos[more], tok[more]))
            state = [np.concatenate(c) for c in zip(*left)]
            query = _CONTRACT_ALL
        alive = token >= 0
        return token[alive].astype("<u4"), np.diff(np.append(0, np.cumsum(alive))[offsets])

    def _known(self, pieces: pa.Array) -> np.ndarray:
        """Where distinct pieces are among the remembered ones, those not met yet being encoded first."""
        if self.pieces.nbytes + self.ids.nbytes + self.sizes.nbytes > REMEMBERED_BYTES:
            self.pieces, self.ids, self.sizes = self.own
        at = pa.compute.index_in(pieces, value_set=self.pieces)
        if at.null_count:
            unmet = pieces.filter(at.is_null())
            ids, sizes = self.contract(unmet)
            new = np.flatnonzero(at.is_null())
            at = np.array(pa.compute.fill_null(at, 0))
            at[new] = len(self.pieces) + np.arange(len(new))
            self.pieces = pa.concat_arrays([self.pieces, unmet])
            self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        return np.asarray(at)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        find = self.pattern.findall if not self.pattern.groups else lambda t: [m[0] for m in self.pattern.finditer(t)]
        pieces, counts = [], []
        for text in texts:
            found = find(text)
            pieces += found
            counts.append(len(found))
        coded = pa.array(pieces, pa.large_string()).dictionary_encode()
        del pieces
        at = self._known(coded.dictionary)[coded.indices.to_numpy()]
        times, start = self.sizes[at], (np.cumsum(self.sizes) - self.sizes)[at]
        ends = np.append(0, np.cumsum(times))
        tokens = self.ids[np.repeat(start - ends[:-1], times) + np.arange(ends[-1])].tobytes()
        cuts = (ends[np.append(0, np.cumsum(counts, dtype=np.int64))] * 4).tolist()
        return [tokens[a:b] for a, b in zip(cuts, cuts[1:])]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of each row of ids."""
        counts = np.array([len(i) // 4 for i in ids], np.int64)
        starts = np.cumsum(counts) - counts
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
        rows = {"doc": np.repeat(np.arange(len(ids)), counts), "pos": np.arange(len(flat)) - np.repeat(starts, counts), "id": flat}
        self.con.register("tokens", pa.table(rows))
        out = [b""] * len(ids)
        found = self._ask(_DECODE, len(flat) // 8)
        self.con.unregister("tokens")
        for doc, text in zip(found["doc"].tolist(), found["bytes"]):
            out[doc] = text.encode("latin-1")
        return out


def _broadcast(rows: DataFrame, ranks_path: str):
    ranks = read_ranks(ranks_path)
    name = hashlib.sha256(b"".join(t + r.to_bytes(4, "little") for t, r in ranks.items())).hexdigest()
    return rows.sparkSession.sparkContext.broadcast((ranks, merge_table(ranks), name))


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
                  decoded: bool = True) -> DataFrame:
    """The columns ``keep`` of every row with ``ids`` (binary, little-endian unsigned 32-bit) and,
    if asked for, ``decoded`` (binary).

    Each match of ``pattern`` is encoded separately, without special tokens. Null and empty texts
    give no ids and empty bytes. Repeated rows each give a row, an empty table none. The vocabulary
    is read on the driver, and broadcast.
    """
    tables = _broadcast(docs, ranks_path)
    schema = [f for f in docs.schema.fields if f.name in keep]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", ids binary" + ", decoded binary" * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, merges, name = tables.value
        codec = Codec(ranks, merges, pattern, name)
        try:
            for batch in batches:
                for part in text_slices(batch, "_text", ENCODE_BYTES):
                    ids = codec.encode([t or "" for t in part.column("_text").to_pylist()])
                    columns = [part.column(f.name) for f in schema] + [pa.array(ids, pa.binary())]
                    if decoded:
                        columns.append(pa.array(codec.decode(ids), pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, [*(f.name for f in schema), "ids", *["decoded"] * decoded])
        finally:
            codec.close()

    return docs.select(*[f.name for f in schema], docs[text_col].alias("_text")).mapInArrow(tidy(run), kinds)


def decode(rows: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with ``decoded`` (binary) from ids (binary, little-endian unsigned 32-bit); null gives empty."""
    tables = _broadcast(rows, ranks_path)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "decoded") + ", decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*tables.value[:2], "")
        try:
            for batch in batches:
                for part in text_slices(batch, ids_col, ENCODE_BYTES):
                    found = codec.decode([i or b"" for i in part.column(ids_col).to_pylist()])
                    yield part.append_column("decoded", pa.array(found, pa.binary()))
        finally:
            codec.close()

    return rows.drop("decoded").mapInArrow(tidy(run), kinds)
