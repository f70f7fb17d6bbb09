"""URL filters against a plain version, with digests that collide and odd addresses."""

import random

import pytest
from pyspark.sql import functions as F

from palimpsest.llm import urls
from palimpsest.llm.queries import URL_RULES


def plain(url, rules, words):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = "".join(c.lower() if c in urls.UPPER else c for c in rest[:cut]), rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    word = None
    if not fits:
        word = next((w for w in "".join(c if c in urls.LOWER + "0123456789" else " " for c in host).split() if w in words), None)
    return host, path, *((max(fits)[1], None, max(fits)[2]) if fits else (None, word, "block" if word else "allow"))


@pytest.mark.parametrize("bits", [64, 3])
def test_judge(spark, bits):
    rng = random.Random(bits)
    host = lambda: ".".join(rng.choice(["a", "b", "www", "net", "COM", "é", "x-spam", ""]) for _ in range(rng.randrange(1, 4)))
    path = lambda: "".join(rng.choice(["/", "a", "b", "/es/", "É"]) for _ in range(rng.randrange(4)))
    rules = {}
    for h, p, v in URL_RULES:
        rules[h, p] = v
    for _ in range(60):
        h, p = host().lower(), path()
        if h and (not p or p[0] == "/"):
            rules[h, p] = rng.choice(["allow", "block"])
    rules = [(h, p, v) for (h, p), v in rules.items()]
    odd = [("", "/", "block"), (None, "/", "block"), ("a", "b", "block"), ("a/b", "", "allow"), ("q", "/", None)]
    given = [None, "", "no scheme/x", "http://", "://a", "http://a", "HTTP://A.NET/es/x?y#z", "http://a?b://c/d", "x\ny://b.net/fr/", "http://user@a.net:80/es/", "http://net./es/", "http://x-spam", "http://spammer.org/", "http://a." + "b" * 70_000 + ".net/es/" + "c" * 70_000]
    given += [f"http{rng.choice(['', 's'])}://{host()}{path()}{rng.choice(['', '?q', '#f/es/'])}" for _ in range(600)] * 2
    listed = urls.build(spark.createDataFrame(rules + odd, "host string, path string, verdict string"), spark.createDataFrame([("Spam",), ("spam",), (None,)], "word string"), bits=bits)
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(given)], "page_id long, url string").withColumns({c: F.lit("own") for c in ("rule", "host", "word", "lengths")})
    got = {r.page_id: (r.host, r.path, r.rule, r.word, r.verdict) for r in urls.judge(rows, listed).collect()}
    assert got == {i: plain(u, rules, {"spam"}) for i, u in enumerate(given)}
    assert len({x[2] for x in got.values()}) > 5 and {x[4] for x in got.values()} == {"allow", "block"} and any(x[3] for x in got.values())


def test_empty_and_contradicting(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    rows = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    empty = urls.build(none)
    assert [r.verdict for r in urls.judge(rows, empty, otherwise="block").collect()] == ["block"]
    assert urls.judge(rows.limit(0), empty).collect() == []
    both = spark.createDataFrame([("a.com", None, "allow"), ("A.com", "", "block")], "host string, path string, verdict string")
    assert [(r.rule, r.verdict) for r in urls.judge(rows, urls.build(both)).collect()] == [("a.com", "block")]


def test_too_long_a_list_is_refused(spark, monkeypatch):
    monkeypatch.setattr(urls, "MOST_BYTES", 10)
    with pytest.raises(ValueError):
        urls.build(spark.createDataFrame([*URL_RULES], "host string, path string, verdict string"))
