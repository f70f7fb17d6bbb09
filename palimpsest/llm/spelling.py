"""Spelling variants by finite-state composition.

Words are near if one inserted, deleted or replaced code point tells them apart. The vocabulary's
minimised acceptor is composed with a one-edit transducer and with the acceptor again, and the pairs
that the composed machine accepts are enumerated. The machine is never built whole: its runs fall
apart by the state in which they begin, which is a context, the letters that both words share before
and after the edit, and each context is enumerated by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, dealt_anew, tidy
from .urls import LOWER, UPPER

#: Letters of words: the class of a run, fixed.
LETTERS = r"[A-Za-zÀ-ÿ]+"

#: Words of a context, beyond which its letters are shared further, and of the contexts that a task holds at once.
MOST_WORDS, CHUNK_WORDS = 2_000, 50_000


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5, least_count: int = 3) -> DataFrame:
    """(word, n): runs of letters of all texts, with a typing error in about one of 97, and how often each occurs.

    A run is lower-cased (A-Z only). With h the CRC-32 of ``id:run``, a run whose h 97 divides loses the
    code point h % length. Words of fewer code points or occurrences are left out. A null text has no
    runs, a null id is an empty one, and repeated rows count as often as they are there.
    """
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("d"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(LETTERS), F.lit(0))).alias("run"))
    low = runs.where(F.length("run") >= least_length).select("d", F.translate("run", UPPER, LOWER).alias("run"))
    h = low.select("run", F.crc32(F.concat("d", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.col("h") % 97 == 0, shorter).otherwise(F.col("run"))
    return h.select(word.alias("word")).where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


class Acceptor:
    """Minimised acceptors of word lists that share their states, as perfect hashes: a word's rank in
    its list is the sum of the offsets on its path. State 0 accepts the empty word alone."""

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.next: list[dict[str, tuple[int, int]]] = [{}]
        self.count = [1]

    def state(self, edges: list[tuple[str, int]]) -> int:
        key = tuple(edges)
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = len(self.next)
            offsets, total = {}, 0
            for c, child in edges:
                offsets[c] = (child, total)
                total += self.count[child]
            self.next.append(offsets)
            self.count.append(total)
        return found

    def add(self, words: list[str]) -> int | None:
        """Initial state for distinct words of one length, in ascending order; None without words."""
        if not words:
            return None
        size = len(words[0])
        open_: list[list[tuple[str, int]]] = [[] for _ in range(size)]  # edges of the states on the path of the last word
        last = None
        for word in [*words, None]:
            shared = 0
            if last is not None:
                while word is not None and word[shared] == last[shared]:
                    shared += 1
                child = 0
                for k in range(size - 1, shared, -1):
                    open_[k].append((last[k], child))
                    child, open_[k] = self.state(open_[k]), []
                if size:
                    open_[shared].append((last[shared], child))
            last = word
        return self.state(open_[0]) if size else 0

    def equal(self, x: int, y: int, a: int, b: int) -> Iterator[tuple[int, int]]:
        """Ranks of equal words of two states, from the ranks a and b on."""
        stack = [(x, y, a, b)]
        while stack:
            x, y, a, b = stack.pop()
            if x == y:
                yield from zip(range(a, a + self.count[x]), range(b, b + self.count[x]))
                continue
            left, right = self.next[x], self.next[y]
            for c in left.keys() & right.keys():
                (p, i), (q, j) = left[c], right[c]
                stack.append((p, q, a + i, b + j))

    def replaced(self, start: int, depth: int) -> Iterator[tuple[int, int]]:
        """Ranks of words of one length that differ in one place, the first ``depth`` ones at most."""
        stack = [(start, 0, 0)]
        while stack:
            x, a, k = stack.pop()
            if self.count[x] < 2 or k >= depth:
                continue
            edges = [*self.next[x].items()]
            for n, (_, (p, i)) in enumerate(edges):
                stack.append((p, a + i, k + 1))
                for _, (q, j) in edges[n + 1 :]:
                    yield from self.equal(p, q, a + i, a + j)

    def inserted(self, short: int, long: int, depth: int) -> Iterator[tuple[int, int]]:
        """Ranks of words and of words with one code point more, whose first difference lies in the first ``depth`` places."""
        stack = [(short, long, 0, 0, 0)]
        while stack:
            x, y, a, b, k = stack.pop()
            if k >= depth:
                continue
            left, right = self.next[x], self.next[y]
            for d, (q, j) in right.items():
                if not left:  # the shorter word is at its end
                    yield a, b + j
                    continue
                after = self.next[q]
                for c in left.keys() & after.keys():
                    if c != d:  # else the pair differs first at a later place
                        yield from self.equal(left[c][0], after[c][0], a + left[c][1], b + j + after[c][1])
                if d in left:
                    stack.append((left[d][0], q, a + left[d][1], b + j, k + 1))


def near_words(groups: list[tuple[int, int, list[tuple[str, int]]]]) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words found, n of the best, the best) for the words of contexts.

    A context is (letters shared before, places in which the first difference may lie, words with their
    n in ascending order by length and word). The best is the most frequent, then the first in order.
    """
    machine = Acceptor()
    for before, depth, rows in groups:
        size = len(rows[0][0])
        cut_at = next((k for k, (w, _) in enumerate(rows) if len(w) > size), len(rows))
        after = len(rows[0][0]) - before  # the shared end is part of both middles, which changes no pair
        short = machine.add([w[before:] for w, _ in rows[:cut_at]]) if after else 0
        long = machine.add([w[before:] for w, _ in rows[cut_at:]])
        found: dict[int, list] = {}
        pairs = [*machine.replaced(short, depth)]
        if long is not None:
            pairs += [(a, cut_at + b) for a, b in machine.inserted(short, long, depth)]
        for a, b in pairs:
            for p, q in ((a, b), (b, a)):
                word, n = rows[q]
                mine = found.setdefault(p, [0, -1, ""])
                mine[0] += 1
                if n > mine[1] or n == mine[1] and word < mine[2]:
                    mine[1:] = n, word
        for p, (n_near, n, best) in found.items():
            yield rows[p][0], n_near, n, best


def _contexts(words: DataFrame, least_length: int) -> DataFrame:
    """(size, before, after, stop, word, n): every word in the contexts of its halves.

    A context is of words with ``size`` code points or one more, which share the letters ``before``
    and ``after``, and of pairs whose first difference lies before ``stop``. Of the two halves of the
    shorter word one is whole: the first where the first difference lies behind it, else the last.
    """
    n = F.length("word")
    sizes = words.select("word", "n", F.explode(F.when(n > least_length, F.array(n, n - 1)).otherwise(F.array(n))).alias("size"))
    half = (F.col("size") / 2).cast("int")
    first = F.struct(F.substring("word", F.lit(1), half).alias("before"), F.lit("").alias("after"), (F.col("size") + 1).alias("stop"))
    last = F.struct(F.lit("").alias("before"), F.substr("word", F.length("word") - F.col("size") + half + 1).alias("after"), half.alias("stop"))
    return sizes.select("size", "word", "n", F.explode(F.array(first, last)).alias("c")).select("size", "c.*", "word", "n")


def _split(rows: DataFrame) -> DataFrame:
    """Contexts whose shared letters grow by half of what lies between them."""
    half = ((F.col("size") - F.length("before") - F.length("after")) / 2).cast("int")
    to = F.length("before") + half
    first = F.struct(F.substring("word", F.lit(1), to).alias("before"), F.col("after"), F.col("stop"))
    last = F.struct(F.col("before"), F.substr("word", F.length("word") - F.col("size") + to + 1).alias("after"), to.alias("stop"))
    return rows.select("size", "word", "n", F.explode(F.array(first, last)).alias("c")).select("size", "c.*", "word", "n")


CONTEXT = ("size", "before", "after", "stop")


def near(words: DataFrame, least_length: int = 5, most_words: int = MOST_WORDS) -> DataFrame:
    """(word, n, n_near, best, best_n) of distinct ``words`` (word, n) of at least ``least_length`` code points.

    Every pair of near words is found in one context, that of its first difference. Contexts of more
    than ``most_words`` words fall into two with more shared letters, again and again, until one place
    is left, where all words are near each other; so no task holds a large one, whatever words begin with.
    """
    pending, ready = _contexts(words, least_length), None
    while True:
        open_places = F.col("size") - F.length("before") - F.length("after")
        heavy = pending.groupBy(*CONTEXT).agg(F.count("*").alias("held")).where((F.col("held") > most_words) & (open_places > 1)).drop("held")
        heavy = cut(heavy)
        if heavy.isEmpty():
            break
        light = pending.join(heavy, [*CONTEXT], "left_anti")
        ready = light if ready is None else ready.unionByName(light)
        pending = cut(_split(pending.join(heavy, [*CONTEXT], "left_semi")))
    rows = pending if ready is None else ready.unionByName(pending)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(groups: list) -> pa.RecordBatch:
            found = [*zip(*near_words(groups))] or [(), (), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(found, (pa.string(), pa.int64(), pa.int64(), pa.string()))], ["word", "n_near", "best_n", "best"])

        groups, held, key, mine = [], 0, None, []
        for batch in batches:
            names = [batch.column(c).to_pylist() for c in (*CONTEXT, "word", "n")]
            for *context, word, n in zip(*names):
                if context != key:
                    if len(mine) > 1 and len(mine[0][0]) == key[0]:  # words that are all one longer meet elsewhere
                        groups.append((len(key[1]), key[3] - len(key[1]), mine))
                        held += len(mine)
                    key, mine = context, []
                    if held >= CHUNK_WORDS:
                        yield out(groups)
                        groups, held = [], 0
                mine.append((word, n))
        if len(mine) > 1 and len(mine[0][0]) == key[0]:
            groups.append((len(key[1]), key[3] - len(key[1]), mine))
        yield out(groups)

    dealt = rows.repartition(*CONTEXT).sortWithinPartitions(*CONTEXT, F.length("word"), "word")
    found = dealt.mapInArrow(tidy(run), "word string, n_near long, best_n long, best string")
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best"))
    every = none.unionByName(found.withColumn("n", F.lit(None).cast("long")))
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))))
    return every.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n", "n_near", F.col("b.word").alias("best"), (-F.col("b.n")).alias("best_n"))


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form), which lead round in no circle: the last form of each word.

    Each step leads from a word's present form to that one's form, so steps double. A form that very many
    words have is a skewed key of a join, which adaptive execution splits.
    """
    current = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        joined = dealt_anew(current, "root").join(dealt_anew(ahead, "root").drop("root"), "dealt", "left")
        current = cut(joined.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        if current.where("moved").isEmpty():
            return current.drop("moved")
        current = current.drop("moved")


def variants(words: DataFrame, least_length: int = 5, times: int = 2, most_words: int = MOST_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary (word, n).

    A word's form is its most frequent near word (of equal ones the first by code points), if that is at
    least ``times`` as frequent; else null, as form_n then is. Its root is where forms lead, or the word
    itself. Words that are null or shorter are left out; of a repeated word the larger n counts. An empty
    vocabulary gives an empty table, and further columns are ignored.
    """
    words = words.where(F.length("word") >= least_length).groupBy("word").agg(F.max(F.col("n").cast("long")).alias("n"))
    words = cut(words)
    due = F.col("best_n") >= times * F.col("n")
    found = cut(near(words, least_length, most_words).select("word", "n", "n_near", F.when(due, F.col("best")).alias("form"), F.when(due, F.col("best_n")).alias("form_n")))
    roots = last_forms(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
