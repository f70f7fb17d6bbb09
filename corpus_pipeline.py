"""A corpus pipeline over ``documents``: each stage is one operator of palimpsest.llm.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents. For every stage: an
empty table gives an empty one, further columns are left out whatever their names, ids and sources
may be null, and repeated rows are separate documents unless said otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import bpe, mixing, pii, simhash, toxicity
from palimpsest.llm.common import remove, shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity chain does not reject.

    Null and empty texts have no features, so they are judged by the chain's bias alone. Without
    labels of both classes nothing is rejected. A document whose score is the threshold is.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.classify(docs.select(*COLUMNS), labels).where(~F.col("is_toxic")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class, that of least doc_id.

    Rows are told apart by doc_id and text, so rows that share an id by mistake are separate
    documents, and rows that share both are one; a null doc_id counts as larger than any. Null and
    empty texts have fingerprint zero, so one of them all stays.
    """
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.xxhash64("text").alias("h"))
    rows = docs.select(*COLUMNS, key.alias("key"))
    classes = simhash.near_duplicates(rows, "key").where("kept").select(F.col("id").alias("key")).distinct()
    same = lambda k: F.struct(F.col(f"{k}.none"), F.coalesce(f"{k}.doc_id", F.lit(0)), F.col(f"{k}.h"))
    return rows.withColumn("same", same("key")).join(classes.select(same("key").alias("same")), "same", "left_semi").dropDuplicates(["same"]).select(*COLUMNS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with each found span replaced by its kind in angle brackets; n_chars follows the text.

    No row goes. Null and empty texts stay as they are; the field is estimated from the stage's input.
    """
    kept = docs.select(*COLUMNS)
    found = pii.find(kept, pii.train(kept), redacted=True)
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    A null source is a source; null and empty texts have size 0 and are taken at the rate of their
    source. Rows that share id and text are taken alike. Of sources of equal rank there are none, as
    ranks follow the name.
    """
    return mixing.mixed(docs.select(*COLUMNS))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each document, with digests of their ids and of the bytes they decode to.

    Null and empty texts have no tokens and the digests of nothing.
    """
    coded = bpe.encode_decode(docs, RANKS, public_tokenizers.PATTERN, keep=("doc_id", "source"))
    return coded.select(
        "doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("byte_level_bpe", tokenize),
]

#: Trained models and DuckDB's recursion inside tasks are beyond one SQL statement; the tests hold
#: run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what lies between them is in the shared folder, and
    goes when the next stage is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    folder = shared_folder(spark)
    for k, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
