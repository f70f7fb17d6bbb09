"""The given tables seen as releases, cells, runs, files and hits. Each has the same view in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FIELDS = ("lang", "source", "text")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide_release(spark: SparkSession, sf_dir: str, version: int) -> DataFrame:
    """Release 1 to 3 of documents: members, texts, languages and sources change by rules on doc_id."""
    docs, n = table(spark, sf_dir, "documents"), F.col("doc_id")
    rows = docs.where({1: n % 10 != 3, 2: n % 10 != 7, 3: ~(n % 10).isin(7, 9)}[version])
    text, lang, source = F.col("text"), F.col("lang"), F.col("source")
    if version > 1:
        text = F.when(n % 4 == 0, F.concat(text, F.lit(" rev2"))).otherwise(text)
    if version == 2:
        lang = F.when(n % 5 != 0, lang)
    if version == 3:
        source = F.when(n % 6 == 0, F.concat(source, F.lit("-x"))).otherwise(source)
    return rows.select(n.cast("string").alias("entry_key"), text.alias("text"), lang.alias("lang"), source.alias("source"))


def release(spark: SparkSession, sf_dir: str, version: int) -> DataFrame:
    """(entry_key, fields) of a release."""
    pairs = F.filter(F.array(*[F.struct(F.lit(f).alias("k"), F.col(f).alias("v")) for f in FIELDS]), lambda p: p["v"].isNotNull())
    return wide_release(spark, sf_dir, version).select("entry_key", F.map_from_entries(pairs).alias("fields"))


RELEASES_SQL = """
r1 AS (SELECT CAST(doc_id AS VARCHAR) AS entry_key, text, lang, source FROM documents WHERE doc_id % 10 <> 3),
r2 AS (SELECT CAST(doc_id AS VARCHAR) AS entry_key, CASE WHEN doc_id % 4 = 0 THEN text || ' rev2' ELSE text END AS text,
       CASE WHEN doc_id % 5 <> 0 THEN lang END AS lang, source FROM documents WHERE doc_id % 10 <> 7),
r3 AS (SELECT CAST(doc_id AS VARCHAR) AS entry_key, CASE WHEN doc_id % 4 = 0 THEN text || ' rev2' ELSE text END AS text, lang,
       CASE WHEN doc_id % 6 = 0 THEN source || '-x' ELSE source END AS source FROM documents WHERE doc_id % 10 NOT IN (7, 9))"""


def release_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [wide_release(spark, sf_dir, v).select("entry_key", F.lit(v).cast("long").alias("version")) for v in (1, 2, 3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


PRESENCE_SQL = """presence AS (SELECT entry_key, 1 AS version FROM r1 UNION ALL SELECT entry_key, 2 FROM r2 UNION ALL SELECT entry_key, 3 FROM r3)"""


def release_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change cells that putting the three releases in order stores.

    An entry absent from a release keeps its state, so its later release is compared with that.
    """
    n = F.col("doc_id")
    docs = table(spark, sf_dir, "documents").select(n, F.array(*[
        F.struct(F.lit(v).cast("long").alias("version"), member.alias("member"), text.alias("text"), lang.alias("lang"), source.alias("source"))
        for v, member, text, lang, source in _by_version(n)]).alias("r"))
    rows = docs.select(n.cast("string").alias("entry_key"), F.explode(F.filter("r", lambda x: x["member"])).alias("r"))
    long = rows.select("entry_key", F.col("r.version").alias("version"), F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f"r.{f}").alias("value")) for f in FIELDS])).alias("c"))
    long = long.select("entry_key", "version", "c.field", "c.value")
    before = F.lag("value").over(Window.partitionBy("entry_key", "field").orderBy("version"))
    changed = long.withColumn("_before", before).where(~F.col("value").eqNullSafe(F.col("_before")))
    return changed.select("entry_key", "field", "version", "value", F.col("value").isNull().alias("is_tombstone"))


def _by_version(n: Column):
    text, revised = F.col("text"), F.when(n % 4 == 0, F.concat("text", F.lit(" rev2"))).otherwise(F.col("text"))
    yield 1, n % 10 != 3, text, F.col("lang"), F.col("source")
    yield 2, n % 10 != 7, revised, F.when(n % 5 != 0, F.col("lang")), F.col("source")
    yield 3, ~(n % 10).isin(7, 9), revised, F.col("lang"), F.when(n % 6 == 0, F.concat("source", F.lit("-x"))).otherwise(F.col("source"))


def event_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entry_key, field, version, value): each user's last value of a day per type of event."""
    day = F.date_format("ts", "yyyyMMdd").cast("long")
    rows = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("entry_key"), F.col("event_type").alias("field"), day.alias("version"), "value", "ts", "event_id")
    return rows.groupBy("entry_key", "field", "version").agg(F.max_by("value", F.struct("ts", "event_id")).alias("value"))


CELLS_SQL = """
cells AS (SELECT CAST(user_id AS VARCHAR) AS entry_key, event_type AS field, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS version,
          arg_max(value, (ts, event_id)) AS value FROM events GROUP BY ALL)"""


def event_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, collection, version, recorded_at): one run per user and day, of the type that came first."""
    day = F.date_format("ts", "yyyyMMdd").cast("long").alias("version")
    first = F.struct("ts", "event_id")
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("run_id"), day).agg(
        F.min_by("event_type", first).alias("collection"), F.min("ts").alias("recorded_at")
    ).select("run_id", "collection", "version", "recorded_at")


RUNS_SQL = """
runs AS (SELECT CAST(user_id AS VARCHAR) AS run_id, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS version,
         arg_min(event_type, (ts, event_id)) AS collection, min(ts) AS recorded_at FROM events GROUP BY 1, 2)"""


def order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(collection, run_id, task_id, version, entries) of orders by priority, month, run and task; run 4 never ran."""
    task = F.lpad((F.col("o_custkey") % 3).cast("string"), 4, "0")
    rows = table(spark, sf_dir, "orders").where("o_custkey % 5 <> 4")
    return rows.groupBy(F.col("o_orderpriority").alias("collection"), (F.col("o_custkey") % 5).cast("string").alias("run_id"), task.alias("task_id"),
                        F.date_format("o_orderdate", "yyyyMM").cast("long").alias("version")).agg(F.count("*").alias("entries"))


VERSIONS_SQL = """
versions AS (SELECT o_orderpriority AS collection, CAST(o_custkey % 5 AS VARCHAR) AS run_id, lpad(CAST(o_custkey % 3 AS VARCHAR), 4, '0') AS task_id,
             CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) AS version, count(*) AS entries FROM orders WHERE o_custkey % 5 <> 4 GROUP BY ALL)"""


def page_files(spark: SparkSession, sf_dir: str, load: int = 1) -> DataFrame:
    """Manifest of pages: (path, size, hash, version, is_deleted); in load 2 some pages changed."""
    path = F.regexp_replace(F.regexp_replace("url", "^https?://", ""), "[?#].*$", "")
    html = F.col("html") if load == 1 else F.when(F.col("page_id") % 5 == 0, F.concat("html", F.lit("<!-- 2 -->"))).otherwise(F.col("html"))
    rows = table(spark, sf_dir, "pages").select(path.alias("path"), "page_id", html.alias("html"))
    rows = rows.groupBy("path").agg(F.min("page_id").alias("page_id"), F.min_by("html", "page_id").alias("html"))
    return rows.select("path", F.length("html").cast("long").alias("size"), F.md5("html").alias("hash"), F.lit(load).cast("long").alias("version"), (F.col("page_id") % 9 == 0).alias("is_deleted"))


def _files_sql(name: str, load: int) -> str:
    html = "html" if load == 1 else "CASE WHEN page_id % 5 = 0 THEN html || '<!-- 2 -->' ELSE html END"
    return f"""
{name} AS (SELECT path, CAST(length(html) AS BIGINT) AS size, md5(html) AS hash, CAST({load} AS BIGINT) AS version, page_id % 9 = 0 AS is_deleted FROM (
    SELECT path, min(page_id) AS page_id, arg_min(html, page_id) AS html FROM (
        SELECT regexp_replace(regexp_replace(url, '^https?://', ''), '[?#].*$', '') AS path, page_id, {html} AS html FROM pages) GROUP BY path))"""


FILES_SQL = _files_sql("files", 1)
FILES2_SQL = _files_sql("files2", 2)


def line_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as search hits, numbered within each query by all columns."""
    q = F.col("l_quantity").cast("int")
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("q"), F.col("l_orderkey") % 500).alias("query_id"), F.concat(F.lit("s"), F.col("l_partkey") % 97).alias("subject_id"),
        F.round(100 - 100 * F.col("l_discount"), 2).alias("identity"), (50 + q).alias("align_length"), F.col("l_linenumber").cast("int").alias("mismatches"),
        (F.col("l_linenumber") % 3).cast("int").alias("gaps"), F.lit(1).alias("query_start"), (50 + q).alias("q_stop"), F.lit(1).alias("s_start"), F.lit(100).alias("s_stop"),
        F.col("l_tax").alias("e_value"), F.col("l_extendedprice").alias("hit"), F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"),
    )
    order = Window.partitionBy("query_id").orderBy("l_orderkey", "mismatches", "l_partkey", "l_suppkey", "align_length", "hit", "identity", "e_value")
    return rows.withColumn("line_no", F.row_number().over(order).cast("long"))


HITS_SQL = """
hits0 AS (SELECT 'q' || (l_orderkey % 500) AS query_id, 's' || (l_partkey % 97) AS subject_id, round(100 - 100 * l_discount, 2) AS identity,
          50 + CAST(l_quantity AS INT) AS align_length, CAST(l_linenumber AS INT) AS mismatches, CAST(l_linenumber % 3 AS INT) AS gaps, 1 AS query_start,
          50 + CAST(l_quantity AS INT) AS q_stop, 1 AS s_start, 100 AS s_stop, l_tax AS e_value, l_extendedprice AS hit, l_orderkey, l_partkey, l_suppkey FROM lineitem),
hits AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY l_orderkey, mismatches, l_partkey, l_suppkey, align_length, hit, identity, e_value) AS line_no FROM hits0)"""


def deleted_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects that the part table no longer backs."""
    return table(spark, sf_dir, "part").where("p_partkey % 97 in (3, 14, 15)").select(F.concat(F.lit("s"), F.col("p_partkey") % 97).alias("entry_key")).distinct()
