"""Alignment of two tokenizers against whole encodings compared byte by byte."""

import hashlib
import json
import random
from collections import Counter
from pathlib import Path

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from palimpsest.llm import alignment
from palimpsest.llm.queries import BYTE_BPE, PIECE_BPE

SF = "/root/testdata/sf0.001"
A_JSON, B_MODEL = Path(BYTE_BPE).read_text("utf-8"), Path(PIECE_BPE).read_bytes()


@pytest.fixture(scope="module")
def coders():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)


def plain(rows, coders):
    """Each byte's tokens of either side; groups end where both end; links are the pairs that share a byte."""
    a, b = coders
    letters = alignment.byte_letters()
    count, kept = Counter(), []
    for i, text in rows:
        whole = (" " + (text or "")).encode()
        ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)] if text else [[], []]
        raw = [[bytes(letters[c] for c in a.id_to_token(x)) for x in ids[0]], [bytes([int(b.id_to_piece(x)[3:5], 16)]) if b.is_byte(x) else b.id_to_piece(x).replace("▁", " ").encode() for x in ids[1]]]
        if not text or any(b"".join(r) != whole for r in raw):
            kept.append((i, [], [], [], []))
            continue
        owner = [[k for k, x in enumerate(r) for _ in x] for r in raw]
        links = sorted(set(zip(*owner)))
        pairs = [(ids[0][p], ids[1][q]) for p, q in links]
        count.update(pairs)
        groups = [[[], []]]
        for at, (p, q) in enumerate(zip(*owner)):
            for side, k in ((0, p), (1, q)):
                if at == 0 or owner[side][at - 1] != k:
                    groups[-1][side].append(str(ids[side][k]))
            if at + 1 < len(whole) and owner[0][at + 1] != p and owner[1][at + 1] != q:
                groups.append([[], []])
        kept.append((i, *ids, [f"{','.join(x)}|{','.join(y)}" for x, y in groups], pairs))
    most = Counter()
    for (_, q), n in count.items():
        most[q] = max(most[q], n)
    return sorted(((i, len(x), len(y), len(g), len(p), sum(count[v] == most[v[1]] for v in p), sum(count[v] for v in p), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, x, y, g, p in kept), key=str)


def aligned(df, **options):
    got = alignment.align(df, A_JSON, B_MODEL, **options)
    return sorted(((r.id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got.collect()), key=str)


@pytest.mark.parametrize("size", [8 << 20, 2_000])
def test_documents(spark, coders, monkeypatch, size):
    monkeypatch.setattr(alignment, "SLICE_TEXT", size)
    monkeypatch.setattr(alignment, "MOST_WINDOWS", size // 20)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = aligned(docs.repartition(3).withColumns({c: F.lit("x") for c in ("id", "slice", "kind", "window", "key", "n", "links", "pair", "b")}))
    assert got == plain(rows, coders) and sum(r[5] for r in got) < sum(r[4] for r in got)


def test_odd_texts(spark, coders):
    rng = random.Random(1)
    parts = ["Hello", " ", "  ", "\n", "\t", "don't", "'s", "''ll", "é", "ß", "²3", "½", "_", "—", "…", "’", "日本", "🙂", "é", "\xa0", "▁", " ", "\x1c", "\x85", "<s>", "<|endoftext|>", "<0x41>", "<unk>", "\x00", "Ω", "ﬁ", "ʯʰ", "#!", "\r\n", "x" * 40]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(1, 25)))) for i in range(400)]
    rows += [(None, "no id"), (3, None), (3, ""), (3, " "), (3, "same"), (3, "same"), (4, "a" * 70_000), (5, " " * 70_000), (6, "wörter " * 20_000)]
    got = aligned(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == plain(rows, coders) and 20 < sum(r[1] == 0 for r in got) < 300
    empty = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert aligned(empty) == [(1, *[0] * 6, ""), (2, *[0] * 6, "")] and aligned(empty.limit(0)) == []


def test_merges_by_rank(coders):
    ranks = alignment.merges_by_rank(A_JSON)
    assert len(ranks) == 50_256 and ranks[b"a"] == coders[0].token_to_id("a")
    model = json.loads(A_JSON)
    merges = model["model"]["merges"]
    merges[:2] = merges[1::-1]
    assert alignment.merges_by_rank(json.dumps(model)) is None


def test_both_ways_of_encoding(spark, coders):
    slow, fast = (alignment.Coder(A_JSON, B_MODEL, r) for r in (None, alignment.merges_by_rank(A_JSON)))
    rng = random.Random(5)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    texts += ["".join(rng.choice("aeiouérstnlTHE 'x.,-\n") for _ in range(rng.randrange(60))) for _ in range(3000)]
    assert all(slow.encode_a(t) == fast.encode_a(t) for t in texts)


def test_groups_are_kept(spark):
    df = spark.createDataFrame([(1, "Hello wörld"), (2, "")], "doc_id long, text string")
    got = {r.id: (r.groups, r.groups_sha256) for r in alignment.align(df, A_JSON, B_MODEL, keep_groups=True).collect()}
    assert hashlib.sha256(got[1][0].encode()).hexdigest() == got[1][1] and got[1][0].count("|") > 1 and got[2] == ("", "")
