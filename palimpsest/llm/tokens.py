"""Token counts by offset-mapped attribution.

Whole documents are encoded once. Each token has a character span; an interval join gives it to
the section whose span holds it, and a token that crosses a boundary goes by an explicit rule.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import read_ranks
from .common import text_bytes, text_slices, tidy

RULES = ("first", "last", "most")

#: Blanks in a row from which on a text is cut into the pattern's pieces here, as the tokenizer's own matching gives up on such runs.
LONG_RUN = 10_000
_LONG_RUN = regex.compile(rf"\s{{{LONG_RUN}}}")


def encode_whole(coder: tiktoken.Encoding, pattern: regex.Pattern, text: str) -> list[int]:
    """Ids of a text of any content: each match of ``pattern`` is encoded by itself, as the tokenizer does it."""
    if not _LONG_RUN.search(text):
        return coder.encode_ordinary(text)
    ids: list[int] = []
    for piece in pattern.finditer(text):
        ids += coder._encode_single_piece(piece.group())
    return ids


def line_bounds(text: str) -> list[int]:
    """Starts of the lines of ``text`` and its length: a line holds its newline."""
    bounds, at = [0], text.find("\n")
    while at >= 0:
        bounds.append(at + 1)
        at = text.find("\n", at + 1)
    return [*bounds, len(text)]


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str = "first") -> np.ndarray:
    """Index of the section each token goes to.

    Sections lie between ascending ``bounds`` and cover the text. ``first``: the section of the
    token's first character; ``last``: of its last; ``most``: of most of its characters, the
    earliest on a tie.
    """
    first = np.searchsorted(bounds, starts, "right") - 1
    last = np.maximum(np.searchsorted(bounds, np.maximum(ends - 1, starts), "right") - 1, first)
    if rule == "first":
        return first
    if rule == "last":
        return last
    best = first.copy()
    most = np.minimum(ends, bounds[first + 1]) - starts
    for i in np.flatnonzero(last > first):
        for s in range(first[i] + 1, last[i] + 1):
            held = min(ends[i], bounds[s + 1]) - max(starts[i], bounds[s])
            if held > most[i]:
                best[i], most[i] = s, held
    return best


def count_sections(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                   bounds_col: str | None = None, rule: str = "first") -> DataFrame:
    """(id, section, start, end, n_tokens, n_crossing) for every section of every row of ``docs``.

    Sections are the lines of the text, or lie between the ascending character positions of the
    array ``bounds_col`` (which need not hold 0 and the length). A text is encoded whole, so counts
    of its sections add up to its tokens; n_crossing counts those of them that reach beyond the
    section. A null or empty text has one empty section; repeated rows and ids each give theirs.
    A token that begins inside a character begins at that character.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})
        pieces = regex.compile(pattern)
        lengths = np.zeros(max(ranks.value.values(), default=0) + 1, np.int64)
        lengths[[*ranks.value.values()]] = [len(t) for t in ranks.value]
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                raw, offsets = text_bytes(part.column("text"))
                chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # characters begun before each byte
                given = part.column("bounds").to_pylist() if bounds_col else None
                row, section, start, end, n, crossing = ([] for _ in range(6))
                for i, text in enumerate(texts):
                    ids = np.array(encode_whole(coder, pieces, text), np.int64)
                    stop = offsets[i] + np.cumsum(lengths[ids])
                    begin = stop - lengths[ids]
                    first = chars[begin + 1] - 1 - chars[offsets[i]] if len(ids) else begin
                    after = chars[stop] - chars[offsets[i]]
                    if given and given[i]:
                        bounds = np.array(sorted({0, len(text), *(b for b in given[i] if b is not None and 0 < b < len(text))}), np.int64)
                    else:
                        bounds = np.array(line_bounds(text) if not bounds_col else [0, len(text)], np.int64)
                    if len(bounds) == 1:
                        bounds = np.array([0, 0])
                    if bounds[-1] == bounds[-2] and len(bounds) > 2:
                        bounds = bounds[:-1]  # text after a last newline is no line
                    m = len(bounds) - 1
                    to = attribute(first, after, bounds, rule) if len(ids) else np.zeros(0, np.int64)
                    over = (first < bounds[to]) | (after > bounds[to + 1])
                    row.append(np.full(m, i)), section.append(np.arange(m)), start.append(bounds[:-1]), end.append(bounds[1:])
                    n.append(np.bincount(to, minlength=m)), crossing.append(np.bincount(to[over], minlength=m))
                cells = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (row, section, start, end, n, crossing)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(cells[0])), *map(pa.array, cells[1:])],
                    ["id", "section", "start", "end", "n_tokens", "n_crossing"])

    wanted = [F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")]
    if bounds_col:
        wanted.append(F.col(bounds_col).cast("array<long>").alias("bounds"))
    return docs.select(*wanted).mapInArrow(tidy(run), "id long, section long, start long, end long, n_tokens long, n_crossing long")
