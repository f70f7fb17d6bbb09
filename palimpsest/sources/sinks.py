"""Text, tabular and XML sinks. Each writes a folder of part files, but for the report, which is one document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..commits import Files
from ..functions.checkpoints import shared_folder
from ..operators.hits import ITERATION_END, REPORT_END, REPORT_HEAD, report_lines
from .files import join_parts


def first_per_key(rendered: DataFrame, key: str = "entry_key", order: tuple[str, ...] = ("run_id", "task_id")) -> DataFrame:
    """One row per rendered key: that of the least run and task."""
    others = [c for c in rendered.columns if c != key]
    return rendered.groupBy(key).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_row")).select(key, "_row.*").select(*rendered.columns)


def key_value_lines(rows: DataFrame, key: str = "text", value: str | None = None) -> DataFrame:
    """key, newline, value; the key alone where the value is empty."""
    if value is None:
        return rows.select(F.col(key).alias("value"))
    return rows.select(F.when(F.coalesce(F.col(value), F.lit("")) == "", F.col(key)).otherwise(F.concat_ws("\n", key, value)).alias("value"))


def write_text(rows: DataFrame, path: str, column: str = "text", mode: str = "overwrite") -> None:
    rows.select(F.col(column).alias("value")).write.mode(mode).text(path)


def split_sorted(rows: DataFrame, parts: int, key: str = "entry_key") -> DataFrame:
    """Rows dealt to ``parts`` files by key, each in key order."""
    return rows.repartition(parts, key).sortWithinPartitions(key)


def split_number(key: Column, parts: int) -> Column:
    """The part that :func:`split_sorted` deals a key to."""
    return F.pmod(F.hash(key), F.lit(parts))


def sorted_report(rows: DataFrame, *order: str, part: str = "file") -> DataFrame:
    """A report in order, by ``part`` first: Spark deals the rows by range, so no task holds them all."""
    return rows.orderBy(part, *order)


def write_xml(nested: DataFrame, path: str) -> None:
    """A nested report as a folder of parts; see :func:`write_report` for one document."""
    nested.write.mode("overwrite").option("rootTag", "BlastOutput_iterations").option("rowTag", "Iteration").xml(path)


def write_report(rows: DataFrame, path: str, program: str, taxon: str = "", parts: int | None = None) -> None:
    """Numbered hits as one XML document at ``path``.

    Tasks write ranges of it in order, and the ranges are joined between its head and its end. A report
    without rows has no iterations.
    """
    spark = rows.sparkSession
    order = ("iteration_no", "hit_no", "hsp_no")
    parts = parts or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    folder = shared_folder(spark)
    at = Files(spark)
    # rows are dealt before they are made text, which is several times as long; parts that must be copied are compressed
    dealt = report_lines(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order), taxon)
    packed = at.of(path)[0].getUri().getScheme() != "hdfs"
    dealt.select("value").write.option("compression", "gzip" if packed else "none").text(folder)
    # a packed part has bytes even if it has no rows
    names = [f"{folder}/{name}" for name, size in at.parts(folder) if size] if not spark.read.text(folder).isEmpty() else []
    escaped = program.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    join_parts(spark, names, path, REPORT_HEAD.format(program=escaped), (ITERATION_END if names else "") + REPORT_END)
    at.delete(folder)


def digest_columns(*columns: str) -> dict[str, Column]:
    """Aggregates that, of rows in any order, make up :func:`digest_text`."""
    h = F.xxhash64(*(columns or ("text",)))
    return {"n": F.count(F.lit(1)), "s": F.sum(h.cast("decimal(20,0)")), "x": F.bit_xor(h)}


def digest_text(got: dict) -> str:
    return f"{got['n']}-{got['s'] or 0}-{got['x'] or 0}"


def result_digest(rows: DataFrame, columns: tuple[str, ...] = ("text",)) -> str:
    """A checksum of the rows in any order, from one aggregation."""
    return digest_text(rows.agg(*[c.alias(n) for n, c in digest_columns(*columns).items()]).first().asDict())


def concatenate(kinds: dict[str, DataFrame]) -> DataFrame:
    """Parts of a result, each once, with a column kind."""
    out = None
    for kind, rows in kinds.items():
        part = rows.withColumn("kind", F.lit(kind))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
