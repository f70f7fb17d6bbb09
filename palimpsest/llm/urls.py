"""URL filters over a sorted digest array.

The list of rules and words becomes Arrow files of 64-bit xxhash keys in ascending order beside the
full strings they stand for. Spark ships the files to its executors, where tasks map them into
memory, probe them with vectorised binary search, and compare the stored string before they believe
a key. So a list takes no heap, and two strings of one digest are told apart.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of strings in a file of the list, and in a list as a whole: every executor gets all its files.
FILE_BYTES, MOST_BYTES = 64 << 20, 2 << 30

#: Words of host names that are blocked where no rule fits.
BLOCKED_WORDS = ("adult", "ads", "adserver", "bet", "bets", "betting", "casino", "escort", "gambling", "malware", "phishing", "pills", "poker", "porn", "sex", "slots", "spam", "viagra", "warez", "xxx")


def address_host(url: Column) -> Column:
    """What stands between the first ``://`` and the next of ``/ ? #``, with A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def address_path(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class UrlList:
    """Names of the files that Spark keeps on every executor, and the bits of a digest that count."""

    files: tuple[str, ...]
    bits: int = 64


def build(rules: DataFrame, words: DataFrame | None = None, bits: int = 64) -> UrlList:
    """The digest array of ``rules`` (host, path, verdict) and of blocked ``words`` (word).

    Hosts and words are lower-cased (A-Z only) and a null path is empty. Rows that can fit nothing are
    left out: a host that is null, empty or holds ``/ ? #``, a path that is not empty and begins with no
    slash, a verdict other than ``allow`` and ``block``, a null or empty word. Of equal rules with both verdicts ``block``
    stays. Each host also has an entry of its own with the lengths of its rules' paths, so that a probe
    asks only for prefixes that exist. Lists of more than ``MOST_BYTES`` are refused. Fewer ``bits``
    make digests collide, for tests.
    """
    spark = rules.sparkSession
    low = lambda c: F.translate(c, UPPER, LOWER)
    kept = rules.where("host rlike '^[^/?#]+$' AND (path IS NULL OR path rlike '^(/|$)') AND verdict IN ('allow', 'block')").select(low(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    none = F.lit(None).cast("array<int>")
    entries = kept.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).select(
        F.concat(F.lit("r"), "host", "path").alias("text"), "verdict", F.array(F.length("host")).alias("lengths")
    ).unionByName(kept.groupBy("host").agg(F.sort_array(F.collect_set(F.length("path"))).alias("lengths")).select(
        F.concat(F.lit("h"), "host").alias("text"), F.lit(None).cast("string").alias("verdict"), "lengths"))
    if words is not None:
        entries = entries.unionByName(words.where("word IS NOT NULL AND word <> ''").select(F.concat(F.lit("w"), low(F.col("word"))).alias("text"), F.lit("block").alias("verdict"), none.alias("lengths")).distinct())
    size = entries.agg(F.sum(F.octet_length("text") + F.lit(24)).alias("n")).first().n or 0
    if size > MOST_BYTES:
        raise ValueError(f"a list of {size} bytes is too long to be sent to every executor")
    digest = F.shiftrightunsigned(F.xxhash64("text"), 64 - bits)
    target = shared_folder(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = [b for b in batches if b.num_rows]
        if not filled:
            return
        rows = pa.Table.from_batches(filled)
        system, base = FileSystem.from_uri(target) if "://" in target or target.startswith("file:") else (LocalFileSystem(), target)
        system.create_dir(base, recursive=True)
        name = f"urls-{uuid.uuid4().hex}.arrow"
        with system.open_output_stream(f"{base}/{name}") as out, pa.ipc.new_file(out, rows.schema) as file:
            file.write_table(rows.combine_chunks())
        yield pa.RecordBatch.from_arrays([pa.array([name])], ["name"])

    dealt = entries.withColumn("digest", digest).repartitionByRange(1 + size // FILE_BYTES, "digest").sortWithinPartitions("digest", "text")
    names = tuple(sorted(r.name for r in dealt.select("digest", "text", "verdict", "lengths").mapInArrow(write, "name string").collect()))
    for name in names:
        spark.sparkContext.addFile(f"{target}/{name}")
    return UrlList(names, bits)


class Mapped:
    """The files of a list, mapped into memory."""

    def __init__(self, listed: UrlList, path: Callable[[str], str] = SparkFiles.get):
        self.shift = np.uint64(64 - listed.bits)
        self.parts = [pa.ipc.open_file(pa.memory_map(path(name))).get_batch(0) for name in listed.files]
        self.digests = [np.asarray(p.column("digest")) for p in self.parts]

    def find(self, texts: list[str]) -> list[tuple[str | None, list[int] | None] | None]:
        """(verdict, lengths) of each text that is stored, else None."""
        found: list = [None] * len(texts)
        keys = (np.array([xxhash.xxh64_intdigest(t.encode(), 42) for t in texts], np.uint64) >> self.shift).view(np.int64)
        asked = pa.array(texts, pa.string())
        for part, digests in zip(self.parts, self.digests):
            at, open_ = np.searchsorted(digests, keys), np.arange(len(texts))
            while len(open_):  # a further round only for keys whose string was another's
                here = at[open_]
                same = here < len(digests)
                same[same] = digests[here[same]] == keys[open_[same]]
                open_, here = open_[same], here[same]
                equal = np.asarray(pa.compute.equal(part.column("text").take(pa.array(here)), asked.take(pa.array(open_))), bool)
                verdicts, lengths = part.column("verdict").take(pa.array(here[equal])).to_pylist(), part.column("lengths").take(pa.array(here[equal])).to_pylist()
                for i, verdict, length in zip(open_[equal], verdicts, lengths):
                    found[i] = (verdict, length)
                open_ = open_[~equal]
                at[open_] += 1
        return found

    def judge(self, hosts: list[str], paths: list[str]) -> list[tuple[str | None, str | None, str | None]]:
        """(rule, word, verdict) of each address."""
        names = dict.fromkeys(hosts)
        ends = {h: [h[k:] for k in [0, *(m.end() for m in re.finditer(r"\.", h))]] for h in names}
        tails = [*dict.fromkeys(e for h in names for e in ends[h])]
        lengths = {t: f[1] for t, f in zip(tails, self.find(["h" + t for t in tails])) if f}
        words = [*dict.fromkeys(w for h in names for w in re.findall("[a-z0-9]+", h))]
        bad = {w for w, f in zip(words, self.find(["w" + w for w in words])) if f}
        asked = [[(t, n) for t in ends[h] for n in lengths.get(t, ()) if n <= len(p)] for h, p in zip(hosts, paths)]
        keys = [*dict.fromkeys(f"{t}{p[:n]}" for p, a in zip(paths, asked) for t, n in a)]
        rules = {k: f for k, f in zip(keys, self.find(["r" + k for k in keys])) if f}
        out = []
        for host, path, probes in zip(hosts, paths, asked):
            fits = [(len(t) + n, len(t), t + path[:n]) for t, n in probes if (t + path[:n]) in rules]
            word = next((w for w in re.findall("[a-z0-9]+", host) if w in bad), None) if not fits else None
            rule = max(fits)[2] if fits else None
            out.append((rule, word, rules[rule][0] if fits else "block" if word else None))
        return out


def judge(pages: DataFrame, listed: UrlList, url_col: str = "url", otherwise: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule, word and verdict.

    A rule fits its host and all subdomains where the path begins with the rule's; of several the
    longest counts. Where none fits, a host with a blocked word is blocked (the first such word is in
    ``word``), and any other address is ``otherwise``. A null url, or one without ``://``, has an empty
    host and path, which no rule fits. Rows, repeated ones too, stay as they are, and columns of pages
    whose names the results take are replaced. Only host and path go through Python.
    """

    @F.pandas_udf("rule string, word string, verdict string")
    def verdicts(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        mapped = Mapped(listed)
        for hosts, paths in batches:
            yield pd.DataFrame(mapped.judge(hosts.tolist(), paths.tolist()), columns=["rule", "word", "verdict"], dtype=object)

    kept = [F.col(f"`{c}`") for c in pages.columns if c not in ("host", "path", "rule", "word", "verdict")]
    host, path = address_host(F.col(url_col)), address_path(F.col(url_col))
    judged = pages.select(*kept, host.alias("host"), path.alias("path"), verdicts(host, path).alias("rule"))
    return judged.select(*kept, "host", "path", F.col("rule.rule").alias("rule"), F.col("rule.word").alias("word"), F.coalesce("rule.verdict", F.lit(otherwise)).alias("verdict"))
