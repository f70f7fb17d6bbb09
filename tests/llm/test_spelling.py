"""Spelling variants against all pairs compared, with contexts split to the last place."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from palimpsest.llm import spelling


def close(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(words):
    out = {}
    for w, n in words.items():
        near = [v for v in words if close(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        out[w] = (best if best is not None and words[best] >= 2 * n else None, n, len(near))
    root = lambda w: w if out[w][0] is None else root(out[w][0])
    return {(w, f, root(w), n, k, words[f] if f else None) for w, (f, n, k) in out.items()}


@pytest.mark.parametrize("most", [2_000, 8, 1])
def test_variants(spark, most):
    rng = random.Random(most)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(5, 9))) for letters in ("ab", "aé", "abcxyzÿ") for _ in range(150)}
    words |= {"anfang" + x + "s" * rng.randrange(2, 4) for x in "abcdefghijklmnopqrstuvwxyzß"} | {x + "ende" for x in "ab"} | {"a" * k for k in range(5, 40)}
    words = {w: rng.choice([3, 3, 4, 6, 7, 12, 25, 100]) for w in words}
    rows = [*words.items(), *[*words.items()][:5], ("abcd", 9), (None, 3)]
    df = spark.createDataFrame(rows, "word string, n long").withColumns({c: F.lit("x") for c in ("form", "root", "size", "before", "dealt")})
    got = spelling.variants(df, most_words=most).collect()
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == plain(words) and len(got) == len(words)


def test_chains_and_long_words(spark):
    long = "lang" * 6_000
    words = {long: 3, long + "x": 9, long[:9_000] + "y" + long[9_001:]: 4, **{"schritt"[:6] + c: 3**k for k, c in enumerate("abcdefgh", 1)}}
    chain = {"b" * (5 + k): 3 * 2**k for k in range(12)}
    got = spelling.variants(spark.createDataFrame([*(words | chain).items()], "word string, n long")).collect()
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == plain(words | chain)
    assert {r.root for r in got if r.word in chain} == {"b" * 16}
    assert spelling.variants(spark.createDataFrame([], "word string, n long")).collect() == []


def test_vocabulary(spark):
    rng = random.Random(2)
    texts = [(i, " ".join(rng.choice(["Hello", "hello,", "Éclair", "éclair", "maßlos", "na", "x1World", "größer-lang", "×÷abc", "ŒUVRES", "İstanbul"]) for _ in range(rng.randrange(80)))) for i in range(60)]
    texts += [(7, "hello world " * 30), (7, "hello world " * 30), (None, "hello null"), (8, None), (9, ""), (10, "wort " * 40_000)]
    expected = Counter()
    for i, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            expected[low[: h % len(low)] + low[h % len(low) + 1 :] if h % 97 == 0 else low] += 1
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("d", "run", "h", "word", "n")})
    got = {r.word: r.n for r in spelling.vocabulary(df).collect()}
    assert got == {w: n for w, n in expected.items() if len(w) >= 5 and n >= 3}
    assert spelling.vocabulary(df.limit(0)).collect() == []
