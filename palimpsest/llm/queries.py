"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, embeddings, html_text, mixing, pii, quality, simhash, spelling, substring, tokens, toxicity, urls

#: The folder of public tokenizers is a package; its files are read where they lie.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_BPE, PIECE_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeat fifty-word windows of earlier ones."""
    found = substring.deduplicate(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, target and words taken of every document in the mix."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document, encoded whole."""
    return tokens.count_sections(_table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and class of every vector."""
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and verdict of every document."""
    judged = quality.assess(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and its text decoded from them, as digests."""
    coded = bpe.encode_decode(_table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page."""
    return html_text.extract_pages(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs))
    count = lambda kind: F.size(F.filter("pii", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(k) for k in pii.KINDS], F.sha2(pii.span_text(F.col("pii"), base_only=True), 256).alias("base_sha256"),
        pii.span_text(F.col("pii")).alias("spans"), F.size("pii").cast("long").alias("n_spans"),
        F.size(F.filter("pii", lambda s: ~s["base"])).cast("long").alias("n_added"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity probabilities and verdict of every document."""
    scored = toxicity.classify(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), _table(spark, sf_dir, "labels"))
    return scored.drop("text", "lang")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), simhash.hex_fingerprint(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )


#: The rules of the query (host, path, verdict).
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))


def op11_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's address."""
    rules = spark.createDataFrame([*URL_RULES], "host string, path string, verdict string")
    words = spark.createDataFrame([(w,) for w in urls.BLOCKED_WORDS], "word string")
    judged = urls.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), urls.build(rules, words))
    return judged.select("page_id", "host", "path", "rule", "verdict", "word")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every word of the documents that occurs three times."""
    return spelling.variants(spelling.vocabulary(_table(spark, sf_dir, "documents")))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers, of every document."""
    found = alignment.align(_table(spark, sf_dir, "documents"), Path(BYTE_BPE).read_text("utf-8"), Path(PIECE_BPE).read_bytes())
    return found.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_substring": op1_substring, "op2_mixing": op2_mixing, "op3_token_counts": op3_token_counts, "op4_embeddings": op4_embeddings, "op5_quality": op5_quality, "op6_bpe": op6_bpe, "op7_html": op7_html, "op8_pii": op8_pii, "op9_toxicity": op9_toxicity, "op10_simhash": op10_simhash, "op11_urls": op11_urls, "op12_spelling": op12_spelling, "op13_alignment": op13_alignment}


_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"

_OP1 = rf"""
WITH w AS (SELECT doc_id, {_WORDS.format("text")} AS words FROM documents),
p AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
g AS (SELECT doc_id, i, word, string_agg(word, ' ') OVER f AS gram, count(*) OVER f AS n FROM p WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)),
f AS (SELECT gram, min(doc_id) AS least FROM g WHERE n = 50 GROUP BY gram),
h AS (SELECT g.doc_id, g.i, g.word, CASE WHEN g.n = 50 AND g.doc_id > f.least THEN 1 ELSE 0 END AS hit FROM g LEFT JOIN f ON f.gram = g.gram),
c AS (SELECT doc_id, i, word, max(hit) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM h),
d AS (SELECT doc_id, sum(gone) AS gone, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept FROM c GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN d ON d.doc_id = w.doc_id"""

_OP2 = rf"""
WITH RECURSIVE sized AS (SELECT doc_id, text, source, CAST(len({_WORDS.format("text")}) AS BIGINT) AS size FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS DOUBLE) AS weight, CAST(source_size * 2 AS DOUBLE) AS most FROM sources),
rounds(k, level) AS (
  SELECT 0, CAST(1.5 AS DOUBLE) * sum(source_size) / sum(weight) FROM ranked
  UNION ALL
  SELECT k + 1, greatest(0, CAST(1.5 AS DOUBLE) * sum(source_size) - sum(CASE WHEN weight * level < most THEN 0 ELSE most END)) / sum(CASE WHEN weight * level < most THEN weight END)
  FROM rounds, ranked WHERE k < 40 GROUP BY k, level),
last AS (SELECT arg_max(level, k) AS level FROM rounds WHERE level IS NOT NULL),
targets AS (SELECT source, source_size, CASE WHEN weight * level < most THEN weight * level ELSE most END AS target FROM ranked, last),
rated AS (SELECT sized.source, doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate, rate - floor(rate) AS part,
  md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '') || '|17') AS digest,
  CAST('0x' || substr(digest, 1, 12) AS BIGINT) AS first, CAST('0x' || substr(digest, 13, 12) AS BIGINT) AS second
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source),
tried AS (SELECT source, k, abs(sum(CASE WHEN CAST((first + k * second) % 281474976710656 AS DOUBLE) / 281474976710656 < part THEN size ELSE 0 END) - any_value(part) * any_value(source_size)) AS off
  FROM rated, range(32) AS seeds(k) GROUP BY source, k),
chosen AS (SELECT source, min(k) AS k FROM tried t WHERE off = (SELECT min(off) FROM tried u WHERE u.source IS NOT DISTINCT FROM t.source) GROUP BY source)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN CAST((first + k * second) % 281474976710656 AS DOUBLE) / 281474976710656 < part THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated JOIN chosen ON rated.source IS NOT DISTINCT FROM chosen.source"""

_OP4 = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a), c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id"""

_PHRASES = " OR ".join(f"contains(lower(line), '{p}')" for p in (q.replace("'", "''") for q in quality.BOILERPLATE))
_OP5 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format("text")} AS words FROM documents),
p AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
g AS (SELECT doc_id, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS gram FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
t AS (SELECT doc_id, i, gram IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, gram) > 1 AS twice FROM g),
c AS (SELECT doc_id, max(twice) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS covered FROM t),
r AS (SELECT doc_id, count_if(covered) AS n_repeat_words FROM c GROUP BY doc_id),
l AS (SELECT doc_id, line, {_WORDS.format("line")} AS ws, line AS whole FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)),
j AS (SELECT doc_id, line, list_sum(list_transform(ws, lambda x: length(x))) AS chars, len(ws) AS n,
  len(ws) > 0 AND ({_PHRASES} OR 3 * len(list_filter(ws, lambda x: regexp_full_match(x, '[|>/»•]+'))) > len(ws) OR 4 * len(list_filter(ws, lambda x: regexp_matches(x, '[#*$%&<>|]$'))) > len(ws)
    OR 2 * len(list_filter(ws, lambda x: regexp_matches(x, '!!$'))) > len(ws)
    OR len(ws) >= 3 AND NOT regexp_matches(right(rtrim(line, ' '), 1), '[\p{{L}}\p{{N}}.!?:;,"''’”)\]…]|^$')) AS bad FROM l),
s AS (SELECT doc_id, count_if(n > 0) AS n_lines, count(DISTINCT CASE WHEN n > 0 THEN line END) AS n_distinct, coalesce(sum(CASE WHEN NOT bad THEN chars END), 0) AS clean FROM j GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, n_lines, n_lines - n_distinct AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, clean
  FROM d JOIN s ON s.doc_id = d.doc_id LEFT JOIN r ON r.doc_id = d.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, CASE WHEN word_chars > 0 THEN 1 - CAST(clean AS DOUBLE) / word_chars ELSE 1 END AS lost FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND lost <= CAST(0.3 AS DOUBLE) AND (n_dup_lines <= 2 OR n_dup_lines <= CAST(0.3 AS DOUBLE) * n_lines) AS kept FROM b"""


_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
_BAD = ", ".join(f"'{w}'" for w in urls.BLOCKED_WORDS)
_OP11 = rf"""
WITH a AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{urls.UPPER}', '{urls.LOWER}') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS (SELECT * FROM (VALUES {_RULES}) AS t(rule_host, rule_path, said)),
f AS (SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(said, length(rule_host || rule_path)) AS said
  FROM a JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id),
w AS (SELECT a.page_id, host, path, rule, said, CASE WHEN rule IS NULL THEN list_filter(regexp_extract_all(host, '[a-z0-9]+'), lambda x: x IN ({_BAD}))[1] END AS word FROM a LEFT JOIN f ON f.page_id = a.page_id)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN word IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, word FROM w"""


_OP12 = rf"""
WITH RECURSIVE tab AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) AS r(i)),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '{spelling.LETTERS}')), '{urls.UPPER}', '{urls.LOWER}') AS run FROM documents),
c AS (SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= 5 GROUP BY ALL),
b AS (SELECT run, k, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM c),
h AS (SELECT run, k, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(x) // 2 + 1), lambda j: CAST('0x' || substr(x, 2 * j - 1, 2) AS BIGINT))), lambda s, v: xor(s >> 8, t[(xor(s, v) & 255) + 1])), 4294967295) AS h FROM b, tab),
w AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM h),
v AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM w WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
i AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v), d AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM i),
p AS (SELECT x.word AS a, y.word AS b FROM d x JOIN d y ON x.i = y.i AND x.less = y.less AND x.word <> y.word
  UNION SELECT d.word, v.word FROM d JOIN v ON d.less = v.word UNION SELECT v.word, d.word FROM d JOIN v ON d.less = v.word),
g AS (SELECT a AS word, count(*) AS n_near, min({{'n': -n, 'word': b}}) AS best FROM p JOIN v ON v.word = b GROUP BY a),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.n >= 2 * v.n THEN best.word END AS form, CASE WHEN -best.n >= 2 * v.n THEN -best.n END AS form_n FROM v LEFT JOIN g ON g.word = v.word),
s(word, here, k) AS (SELECT word, word, 0 FROM f UNION ALL SELECT s.word, f.form, k + 1 FROM s JOIN f ON f.word = s.here WHERE f.form IS NOT NULL),
r AS (SELECT word, arg_max(here, k) AS root FROM s GROUP BY word)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN r ON r.word = f.word"""


def oracle_sql() -> dict[str, str]:
    """SQL for the operators that it can express; tests hold the others against brute force."""
    return {"op1_substring": _OP1, "op2_mixing": _OP2, "op4_embeddings": _OP4, "op5_quality": _OP5, "op11_urls": _OP11, "op12_spelling": _OP12}
