"""The whole pipeline against a plain version of its five stages."""

import hashlib
import re
from collections import Counter
from itertools import combinations

import corpus_pipeline
import numpy as np
import public_tokenizers
import tiktoken

from palimpsest.llm import bpe, pii, simhash, toxicity

from test_operators import SF, WORD, brute_chain, brute_spans, brute_targets


def plain_classes(prints):
    """The least id of each class of fingerprints at two or fewer differing bits."""
    least, changed = {i: i for i in prints}, True
    while changed:
        changed = False
        for a, b in combinations(sorted(prints), 2):
            if least[a] != least[b] and (prints[a] ^ prints[b]).bit_count() <= 2:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    return least


def plain_mix(docs, seeds=32, span=1 << 48):
    """Copies of each document: floor of the rate, and coins of the seed nearest to the source's fraction."""
    sizes, copies = Counter(), {}
    for _, text, source in docs:
        sizes[source] += len(WORD.findall(text))
    targets = brute_targets(sizes)
    for source, size in sizes.items():
        own = [(i, len(WORD.findall(t)), hashlib.md5(f"{i}|{t}|17".encode()).hexdigest()) for i, t, s in docs if s == source]
        rate = targets[source] / size
        part = rate - int(rate)
        toss = lambda digest, k: (int(digest[:12], 16) + k * int(digest[12:24], 16)) % span / span < part
        off = [abs(sum(n for _, n, d in own if toss(d, k)) - part * size) for k in range(seeds)]
        best = off.index(min(off))
        copies |= {i: int(rate) + toss(d, best) for i, _, d in own}
    return copies


def test_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    chain = toxicity.train(docs.select("doc_id", "text", "lang"), spark.read.parquet(f"{SF}/labels.parquet"), toxicity.label_categories())
    rows = [(r.doc_id, r.text or "", r.source) for r in docs.collect()]
    rows = [r for r in rows if brute_chain(chain, r[1])[-1] < chain[-1].threshold]
    least = plain_classes({i: simhash.fingerprint(t.encode()) for i, t, _ in rows})
    rows = [r for r in rows if least[r[0]] == r[0]]
    assert 0 < len(rows) < docs.count()
    base = [brute_spans(t) for _, t, _ in rows]
    graph = pii.build_graph([t for _, t, _ in rows], base)
    more = pii.added_spans([t for _, t, _ in rows], base, pii.estimate(pii.statistics(graph)))
    clean = []
    for (i, t, s), b, m in zip(rows, base, more):
        at, out = 0, ""
        for start, end, kind in sorted(b + m, key=lambda x: (x[0], x[2], x[1])):
            if start >= at:
                out += t[at:start] + f"<{pii.LABELS[kind].upper()}>"
            at = max(at, end)
        clean.append((i, out + t[at:], s))
    assert sum("<" in t and re.search("<(EMAIL|IP|CARD|PHONE)>", t) is not None for _, t, _ in clean) > 0
    copies = plain_mix(clean)
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(corpus_pipeline.RANKS), special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    expected = Counter()
    for i, t, s in clean:
        ids = coder.encode_ordinary(t)
        expected[i, s, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(t.encode())] += copies[i]
    got = Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).select("doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256").collect())
    assert got == +expected
