"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from palimpsest.llm import bpe, embeddings, html_text, mixing, pii, quality, simhash, substring, tokens, toxicity
from palimpsest.llm.queries import RANKS

PATTERN = r"\S+|\s+"
LONG = "lorem ipsum dolor " * 20_000
ROWS = [
    (1, "a b c d", "en", "s", 7), (1, "a b c d", "en", "s", 7), (1, "another text", None, None, None), (None, None, None, None, None),
    (None, "only text", "en", None, 9), (2, "", "en", "s", 0), (3, " \n\t ", "de", "t", 4), (4, LONG, "en", "t", len(LONG)), (5, "é日本🙂 " * 60, "fr", "t", 300),
]
#: Names that operators use inside, or add.
EXTRA = ("id", "h", "row", "key", "copy", "fingerprint", "variant", "component", "label", "kept", "n_words", "_words", "mix_size", "_mix_key", "ids", "pii", "p_toxic", "toxic", "start", "end", "usable", "node", "prefix")


def documents(spark, rows=ROWS):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("x") for c in EXTRA})


def labels(spark, rows=((1, 1, 0), (2, 0, None), (None, 1, 1), (99, None, 1))):
    return spark.createDataFrame([*rows], "doc_id long, quality int, toxic int")


OPERATORS = {
    "substring": lambda d: substring.deduplicate(d),
    "mix": lambda d: mixing.mix(d),
    "tokens": lambda d: tokens.count_sections(d, RANKS, PATTERN),
    "quality": lambda d: quality.assess(d),
    "bpe": lambda d: bpe.encode_decode(d, RANKS, PATTERN),
    "html": lambda d: html_text.extract_pages(d, "text", "seen"),
    "pii": lambda d: pii.find(d, pii.train(d)),
    "toxicity": lambda d: toxicity.classify(d, labels(d.sparkSession)),
    "simhash": lambda d: simhash.near_duplicates(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_rows_in_rows_out(spark, name):
    rows = OPERATORS[name](documents(spark)).collect()
    if name == "tokens":
        assert {(r.id, r.section) for r in rows} >= {(1, 0), (None, 0), (2, 0), (3, 1), (4, 0)}
    else:
        assert len(rows) == len(ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](documents(spark, [])).collect() == []


def test_values(spark):
    got = {(r.id, r.n_words, r.n_removed, r.kept_text[:8]) for r in substring.deduplicate(documents(spark)).collect()}
    assert {(1, 4, 0, "a b c d"), (None, 0, 0, ""), (2, 0, 0, ""), (3, 0, 0, ""), (None, 2, 0, "only tex"), (4, 60_000, 0, "lorem ip")} <= got
    zero = [r for r in simhash.near_duplicates(documents(spark)).collect() if r.fingerprint == 0]
    assert len(zero) == 3 and {r.component_id for r in zero} == {2} and [r.id for r in zero if r.kept] == [2]
    judged = {(r.doc_id, r.n_words): r for r in quality.assess(documents(spark)).collect()}
    assert judged[None, 0].base_failed and not judged[None, 0].kept and judged[4, 60_000].n_repeat_words == 60_000
    coded = {r.doc_id: r for r in bpe.encode_decode(documents(spark), RANKS, PATTERN).where("doc_id > 1").collect()}
    assert bytes(coded[2].ids) == b"" and bytes(coded[4].decoded).decode() == LONG
    flags = toxicity.classify(documents(spark), labels(spark))
    assert "is_toxic" in flags.columns and not any(r.is_toxic for r in flags.collect())


def test_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [0.0, 0.0], 1), (4, None, 1), (5, [1.0, None], 1), (6, [nan, 1.0], 1),
            (7, [inf, 1.0], 1), (8, [1.0, 0.0], None), (9, [1.0, 0.0], 2), (10, [], 1), (11, [1.0, 0.0, 0.0], 1), (None, [0.0, 1.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit(1) for c in ("id", "v", "key", "node", "part", "copies")})
    got = sorted(((r.id, r.n_links, r.component_id) for r in embeddings.near_duplicates(df).collect()), key=str)
    linked = [(1, 2, 1), (2, 2, 1), (2, 2, 1)]
    assert got == sorted(linked + [(i, 0, i) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11, None)], key=str)
    assert embeddings.near_duplicates(df.limit(0)).collect() == []


def test_stages(spark, tmp_path):
    labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    for rows in (ROWS, []):
        docs = documents(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
            docs.write.mode("overwrite").parquet(str(tmp_path / f"{len(rows)}_{name}"))
            docs = spark.read.parquet(str(tmp_path / f"{len(rows)}_{name}"))
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == list(corpus_pipeline.COLUMNS)
            if name == "simhash_near_dedup" and rows:
                kept = docs.collect()
                assert sum(r.text == "a b c d" for r in kept) == 1 and {"another text", "only text"} <= {r.text for r in kept}
        assert (docs.count() > 0) == bool(rows)


def test_long_runs_of_blanks(spark):
    """Texts that tiktoken alone gives up on; the pattern and ranks of the query."""
    import public_tokenizers
    import tiktoken

    ranks = bpe.read_ranks(RANKS)
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    short = "a" + " " * 12_000 + "\n\t b  c\n" + "\n" * 11_000 + "don't" + " " * 10_001
    assert tokens.encode_whole(coder, tokens.regex.compile(public_tokenizers.PATTERN), short) == coder.encode_ordinary(short)
    texts = ["a" + " " * 1_000_000, " " * 1_000_000, "\n" * 1_000_000 + "x y", "a" * 1_000_000]
    got = tokens.count_sections(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string"), RANKS, public_tokenizers.PATTERN)
    rows = {r.id: (r.n, r.last) for r in got.groupBy("id").agg(F.sum("n_tokens").alias("n"), F.max("end").alias("last")).collect()}
    assert all(rows[i][1] == len(t) for i, t in enumerate(texts)) and rows[0][0] == 1_000_001 and rows[3][0] < 500_000


def test_tiny_and_huge_vectors(spark):
    rows = [(1, [1e-200, 0.0], 1), (2, [1e200, 0.0], 1), (3, [2.0, 0.0], 1), (4, [3e-320, 0.0], 1), (5, [1e200, 1e200], 1), (6, [1e-200, 1e-200], 1), (7, [-1e-200, 0.0], 1), (8, [1.7e308, 0.0], 1)]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {(r.id, r.n_links, r.component_id) for r in got} == {(i, 4, 1) for i in (1, 2, 3, 4, 8)} | {(5, 1, 5), (6, 1, 5), (7, 0, 7)}


def test_contradicting_labels(spark):
    docs = spark.createDataFrame([(i, ("kind words of praise " if i % 2 else "vile abuse and threats ") * (1 + i % 3) + f"w{i}", "en") for i in range(60)], "doc_id long, text string, lang string")
    marks = [(i, 1, int(i % 2 == 0)) for i in range(60)] + [(i, 1, 0) for i in range(0, 60, 4)] + [(i, None, None) for i in range(60)]
    seen = set()
    for parts, given in ((1, marks), (7, marks), (3, marks[:60])):  # the greatest label of an id counts
        found = toxicity.classify(docs.repartition(parts), spark.createDataFrame(given, "doc_id long, quality int, toxic int").repartition(parts)).collect()
        seen.add(tuple(sorted((r.doc_id, r.is_toxic, r.p_toxic) for r in found)))
    assert len(seen) == 1


def test_near_duplicates_without_an_id(spark):
    rows = [(None, "one two three", "en", "s", 1), (-1, "one two three", "en", "s", 1), (0, "four five six seven", "en", "s", 1), (None, "four five six seven", "en", "s", 1), (None, "eight nine ten", "en", "s", 1)]
    kept = corpus_pipeline.drop_near_duplicates(spark, documents(spark, rows), "").collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == [("-1", "one two three"), ("0", "four five six seven"), ("None", "eight nine ten")]
