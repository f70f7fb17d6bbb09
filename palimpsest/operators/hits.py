"""Corrections to search results after an incremental search.

``hits`` has the twelve tabular columns of ``HIT_COLUMNS``; where order matters also line_no, the
place of the line within its query (or file: pass ``part``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, NumericType, StructField, StructType

from ..functions.checkpoints import cut, numbered
from ..functions.text import rescaled

# The column names of the tabular format.
HIT_COLUMNS = ("query_id", "subject_id", "identity", "align_length", "mismatches", "gaps", "query_start", "q_stop", "s_start", "s_stop", "e_value", "hit")
HIT_SCHEMA = (
    "query_id string, subject_id string, identity double, align_length int, mismatches int, gaps int, "
    "query_start int, q_stop int, s_start int, s_stop int, e_value double, hit double"
)


def derived(hits: DataFrame) -> DataFrame:
    """Lengths of query and subject, and the counts of identical and positive positions."""
    length = F.col("q_stop") - F.col("query_start")
    return (
        hits.withColumn("query_len", length).withColumn("subject_len", F.col("s_stop") - F.col("s_start"))
        .withColumn("identical", F.col("query_len") - F.col("mismatches")).withColumn("positive", F.col("identical") - F.col("gaps"))
    )


def correct(hits: DataFrame, deleted: DataFrame, full: Column, incremental: Column) -> DataFrame:
    """Hits on subjects that are not deleted, e-values rescaled to the full collection.

    The deleted list joins by hash of the subject (Catalyst broadcasts it while it is small).
    """
    kept = hits.join(deleted.select(F.col("entry_key").alias("subject_id")).distinct(), "subject_id", "left_anti")
    return derived(kept.withColumn("e_value", rescaled(F.col("e_value"), full, incremental)))


@dataclass(frozen=True)
class _Open:
    """Where reading stands: the part and island that are open, the island's number and first HSP, and how many rows and repeats of that HSP it has had."""

    part: str | None = None
    key: str | None = None
    island: int = 0
    first: str | None = None
    kept: int = 0
    rows: int = 0


def _changes(column: pa.Array, before: str | None) -> np.ndarray:
    """Whether each value differs from the one before it."""
    differs = np.ones(len(column), bool)
    differs[1:] = np.asarray(pc.not_equal(column[1:], column[:-1]))
    differs[0] = column[0].as_py() != before
    return differs


def _read(batch: pa.RecordBatch, at: _Open) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, _Open]:
    """(island, whether the row repeats its island's first HSP, repeats before it, rows before it) of rows in order, and where reading then stands."""
    part, key, hsp = (batch.column(c) for c in ("_in", "_key", "_hsp"))
    opens = _changes(part, at.part)
    begins = opens | _changes(key, at.key)
    index, count = np.arange(batch.num_rows), np.cumsum(begins)
    opened, begun = (np.maximum.accumulate(np.where(x, index, -1)) for x in (opens, begins))
    island = count - np.where(opened >= 0, count[opened] - 1, -at.island)
    same = np.asarray(pc.equal(hsp, hsp.take(pa.array(np.maximum(begun, 0)))))
    if begun[0] < 0:
        same = np.where(begun < 0, np.asarray(pc.equal(hsp, at.first)), same)
    repeats = np.cumsum(same)
    before = repeats - np.where(begun >= 0, repeats[begun] - 1, -at.kept)
    rows = np.where(begun >= 0, index - begun, at.rows + index)
    first = hsp[int(begun[-1])].as_py() if begun[-1] >= 0 else at.first
    return island, same, before - 1, rows, _Open(part[-1].as_py(), key[-1].as_py(), int(island[-1]), first, int(before[-1]), int(rows[-1]) + 1)


def _ends(marked: DataFrame) -> dict[int, Row]:
    """Of each range of rows, read by itself: its first part and island, whether a part or an island begins after its first row, and where reading ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, first, parts, islands = _Open(), None, False, False
        for batch in (b for b in batches if b.num_rows):
            opens, begins = _changes(batch.column("_in"), at.part), _changes(batch.column("_key"), at.key)
            parts, islands = parts or bool(opens[first is None :].any()), islands or bool((opens | begins)[first is None :].any())
            first = first or (batch.column("_range")[0].as_py(), batch.column("_in")[0].as_py(), batch.column("_key")[0].as_py())
            at = _read(batch, at)[-1]
        if first is not None:
            values = (*first, parts, islands, at.part, at.key, at.island, at.first, at.kept, at.rows)
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], ["range", "part_0", "key_0", "parts", "islands", "part", "key", "island", "first", "kept", "rows"])

    schema = "range long, part_0 string, key_0 string, parts boolean, islands boolean, part string, key string, island long, first string, kept long, rows long"
    return {r.range: r for r in marked.select("_range", "_in", "_key", "_hsp").mapInArrow(run, schema).collect()}


def _carried(ends: dict[int, Row], repeats: dict[int, int]) -> dict[int, _Open]:
    """Where reading stands before each range, from the ends of ranges read by themselves. ``repeats`` has, for ranges
    inside one island, how often they repeat its first HSP."""
    at, before = _Open(), {}
    for k in sorted(ends):
        e, before[k] = ends[k], at
        end = _Open(e.part, e.key, e.island, e.first, e.kept, e.rows)
        if not e.parts and at.part == e.part_0:  # a part goes on through the whole range
            goes_on = at.key == e.key_0
            end = replace(end, island=at.island + e.island - goes_on)
            if goes_on and not e.islands:
                end = replace(end, first=at.first, rows=at.rows + e.rows, kept=at.kept + repeats.get(k, 0))
        at = end
    return before


def islands(hits: DataFrame, part: Sequence[str] = ("query_id",), keep: str = "first") -> DataFrame:
    """Rows in reading order with iteration_hit and hsp numbers.

    An island is a run of rows with one query, query length, subject and subject length. Of its
    rows the first and its exact repeats stay (``keep="first"``), or all (``keep="all_hsps"``).

    Rows are dealt by ranges of (part, line_no), so one query's rows may fall into any number of tasks. A
    first pass reads each range by itself and gives one row a range, from which the driver works out where
    reading stands at each range's begin; a second pass reads on from there.
    """
    spark = hits.sparkSession
    ranges = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = derived(cut(hits.repartitionByRange(ranges, *part, "line_no").sortWithinPartitions(*part, "line_no").withColumn("_range", F.spark_partition_id())))
    rows = dealt.drop("_range")  # lengths and counts are worked out after, so that they are not written
    text = lambda *names: F.to_json(F.struct(*names))
    hsp = ("identity", "align_length", "mismatches", "gaps", "query_start", "q_stop", "s_start", "s_stop", "e_value", "hit")
    marked = dealt.withColumns({"_in": text(*part), "_key": text("query_id", "query_len", "subject_id", "subject_len"), "_hsp": text(*hsp)})
    ends = _ends(marked)
    before = _carried(ends, {})
    inside = [(k, before[k].first) for k, e in ends.items() if not e.islands and (before[k].part, before[k].key) == (e.part_0, e.key_0)]
    if inside:  # ranges that one island fills count its first HSP, which is of an earlier range
        wanted = F.broadcast(spark.createDataFrame(inside, "_range int, _first string"))
        found = marked.join(wanted, "_range").where(F.col("_hsp") == F.col("_first")).groupBy("_range").agg(F.count("*").alias("n")).collect()
        before = _carried(ends, {r["_range"]: r.n for r in found})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in (b for b in batches if b.num_rows):
            island, same, repeats, rows_before, at = _read(batch, before[batch.column("_range")[0].as_py()] if at is None else at)
            out = pa.RecordBatch.from_arrays([*batch.columns[:-4], pa.array(island), pa.array(repeats if keep == "first" else rows_before)], [*batch.schema.names[:-4], "island", "hsp_no"])
            yield out.filter(pa.array(same)) if keep == "first" else out

    schema = StructType([*rows.schema.fields, StructField("island", LongType()), StructField("hsp_no", LongType())])
    numbered_rows = marked.select(*rows.columns, "_range", "_in", "_key", "_hsp").mapInArrow(run, schema)
    # an island's first row always stays, so in a query's own part islands are numbered as hits are
    hit_no = F.col("island") if tuple(part) == ("query_id",) else F.dense_rank().over(Window.partitionBy(*part, "query_id").orderBy("island"))
    return numbered_rows.withColumns({"hsp_no": F.col("hsp_no").cast("int"), "hit_no": hit_no.cast("int")})


def iterations(rows: DataFrame, order: Sequence[str] = ("line_no",), hits: DataFrame | None = None) -> DataFrame:
    """``rows`` with iteration_no, by the first appearance of the query in ``order``, which tells all
    rows apart; the queries are numbered by ranges, so no task holds them all.

    First appearances are taken from ``hits`` where given: as a query's first row always stays, those that
    :func:`islands` began with will do, and are not worked out for it again.
    """
    firsts = (rows if hits is None else hits).groupBy("query_id").agg(F.min(F.struct(*order)).alias("_first"))
    return rows.join(numbered(firsts, "iteration_no", F.col("_first")).drop("_first"), "query_id")


def nested(rows: DataFrame, taxon: str = "") -> DataFrame:
    """One row per iteration with its hits, and their HSPs, nested as the XML report has them.

    A query's hits make one row, so this is for results whose queries have few; :func:`report_lines` has no such row.
    """
    hsp = F.struct(
        F.col("hsp_no").alias("Hsp_num"), F.col("align_length").alias("Hsp_align-len"), F.col("e_value").alias("Hsp_evalue"), F.col("identical").alias("Hsp_identity"),
        F.col("positive").alias("Hsp_positive"), F.col("hit").alias("Hsp_score"), F.col("query_start").alias("Hsp_query-from"), F.col("q_stop").alias("Hsp_query-to"),
        F.col("s_start").alias("Hsp_hit-from"), F.col("s_stop").alias("Hsp_hit-to"),
    )
    hits = rows.groupBy("iteration_no", "query_id", "query_len", "hit_no", "subject_id", "subject_len").agg(F.array_sort(F.collect_list(hsp)).alias("hsps"))
    hit = F.struct(
        F.col("hit_no").alias("Hit_num"), F.concat_ws(" ", "subject_id", F.nullif(F.lit(taxon), F.lit(""))).alias("Hit_def"), F.col("subject_len").alias("Hit_len"), F.struct(F.col("hsps").alias("Hsp")).alias("Hit_hsps")
    )
    out = hits.groupBy("iteration_no", "query_id").agg(F.max("query_len").alias("query_len"), F.array_sort(F.collect_list(hit), lambda a, b: a["Hit_num"] - b["Hit_num"]).alias("hits"))
    return out.select(
        F.col("iteration_no").alias("Iteration_iter-num"), F.col("query_id").alias("Iteration_query-def"), F.col("query_len").alias("Iteration_query-len"), F.struct(F.col("hits").alias("Hit")).alias("Iteration_hits")
    )


# What stands around the iterations of a report, and the elements of an HSP.
REPORT_HEAD = """<?xml version="1.0"?>
<!DOCTYPE BlastOutput PUBLIC "-//NCBI//NCBI BlastOutput/EN" "http://www.ncbi.nlm.nih.gov/dtd/NCBI_BlastOutput.dtd">
<BlastOutput>
  <BlastOutput_program>{program}</BlastOutput_program>
  <BlastOutput_iterations>
"""
REPORT_END = "  </BlastOutput_iterations>\n</BlastOutput>\n"
HIT_END = "          </Hit_hsps>\n        </Hit>\n"
ITERATION_END = HIT_END + "      </Iteration_hits>\n    </Iteration>\n"
HSP_ELEMENTS = (
    ("Hsp_num", "hsp_no"), ("Hsp_align-len", "align_length"), ("Hsp_evalue", "e_value"), ("Hsp_identity", "identical"), ("Hsp_positive", "positive"), ("Hsp_score", "hit"),
    ("Hsp_query-from", "query_start"), ("Hsp_query-to", "q_stop"), ("Hsp_hit-from", "s_start"), ("Hsp_hit-to", "s_stop"),
)


def _escaped(value: Column) -> Column:
    out = F.regexp_replace(value.cast("string"), "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]", "")
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(mark), F.lit(name))
    return F.coalesce(out, F.lit(""))


def report_lines(rows: DataFrame, taxon: str = "") -> DataFrame:
    """(iteration_no, hit_no, hsp_no, value): the report's text, a row for an HSP.

    In order, each row closes what ends before it and opens what begins with it, as its own numbers tell;
    so any number of tasks write the report, however many hits one query has. Characters that XML does
    not allow are left out.
    """
    element = lambda indent, name, value: F.concat(F.lit(f"{' ' * indent}<{name}>"), value, F.lit(f"</{name}>\n"))
    numbers = {f.name for f in rows.schema.fields if isinstance(f.dataType, NumericType)}  # these have nothing to escape
    written = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in numbers else _escaped(F.col(c))
    starts_hit = F.col("hsp_no") == 0
    starts_iteration = starts_hit & (F.col("hit_no") == 1)
    closes = F.when(starts_iteration, F.when(F.col("iteration_no") > 1, ITERATION_END)).when(starts_hit, HIT_END)
    query = F.concat(F.lit("    <Iteration>\n"), element(6, "Iteration_iter-num", F.col("iteration_no")), element(6, "Iteration_query-def", _escaped(F.col("query_id"))),
                     element(6, "Iteration_query-len", written("query_len")), F.lit("      <Iteration_hits>\n"))
    subject = F.concat_ws(" ", _escaped(F.col("subject_id")), F.nullif(_escaped(F.lit(taxon)), F.lit("")))
    hit = F.concat(F.lit("        <Hit>\n"), element(10, "Hit_num", F.col("hit_no")), element(10, "Hit_def", subject), element(10, "Hit_len", written("subject_len")), F.lit("          <Hit_hsps>\n"))
    hsp = F.concat(F.lit("            <Hsp>\n"), *[element(14, name, written(c)) for name, c in HSP_ELEMENTS], F.lit("            </Hsp>"))
    value = F.concat_ws("", closes, F.when(starts_iteration, query), F.when(starts_hit, hit), hsp)
    return rows.select("iteration_no", "hit_no", "hsp_no", value.alias("value"))
