"""One query per operator family over the given tables, and SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..commits import Files
from ..functions.checkpoints import shared_folder
from ..functions import text
from ..functions.text import cache_key, task_key
from ..operators import asof, counts, diff, filters, hits, lineage, manifest
from ..sources import files, formats, records, sinks
from ..store import Store
from ..streaming.ingest import ingest
from . import fixtures as fx

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its name, with the SQL it is held against."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


@query(f"""WITH {fx.RELEASES_SQL},
both_sides AS (SELECT b.entry_key, unnest(['text', 'lang', 'source']) AS field, unnest([a.text, a.lang, a.source]) AS old, unnest([b.text, b.lang, b.source]) AS new
               FROM r2 b LEFT JOIN r1 a ON a.entry_key = b.entry_key)
SELECT entry_key, field, md5(new) AS value_md5, new IS NULL AS is_tombstone FROM both_sides WHERE new IS DISTINCT FROM old""")
def release_diff_fields(spark, sf_dir):
    """Field changes that turn release 1 into release 2."""
    changes = diff.changed_fields(fx.release(spark, sf_dir, 1), fx.release(spark, sf_dir, 2))
    return changes.select("entry_key", "field", F.md5("value").alias("value_md5"), "is_tombstone")


@query(f"""WITH {fx.RELEASES_SQL}
SELECT coalesce(a.entry_key, b.entry_key) AS entry_key, CASE WHEN a.entry_key IS NULL THEN 'added' WHEN b.entry_key IS NULL THEN 'removed'
  WHEN a.text IS DISTINCT FROM b.text OR a.lang IS DISTINCT FROM b.lang OR a.source IS DISTINCT FROM b.source THEN 'modified' ELSE 'kept' END AS change
FROM r1 a FULL JOIN r2 b ON a.entry_key = b.entry_key""")
def release_diff_entries(spark, sf_dir):
    """Entries added, removed, modified and kept from release 1 to 2."""
    return diff.entry_changes(fx.release(spark, sf_dir, 1), fx.release(spark, sf_dir, 2))


@query(f"""WITH {fx.RELEASES_SQL}
SELECT a.entry_key, concat_ws(',', CASE WHEN a.lang = b.lang THEN 'lang' END, CASE WHEN a.source = b.source THEN 'source' END, CASE WHEN a.text = b.text THEN 'text' END) AS fields
FROM r1 a JOIN r2 b ON a.entry_key = b.entry_key""")
def equal_fields(spark, sf_dir):
    """Fields that are equal in releases 1 and 2."""
    return diff.equal_fields(fx.release(spark, sf_dir, 1), fx.release(spark, sf_dir, 2)).withColumn("fields", F.array_join("fields", ","))


@query(f"""WITH {fx.RELEASES_SQL} SELECT a.entry_key, 'lang' AS field FROM r1 a JOIN r2 b ON a.entry_key = b.entry_key WHERE a.lang IS NOT NULL AND b.lang IS NULL""")
def vanished_fields(spark, sf_dir):
    """Fields that entries of release 1 lost in release 2."""
    return diff.vanished_fields(fx.release(spark, sf_dir, 1), fx.release(spark, sf_dir, 2))


@query(f"""WITH {fx.CELLS_SQL} SELECT * EXCLUDE (b, n) FROM (SELECT *, lag(value) OVER w AS b, row_number() OVER w AS n FROM cells WINDOW w AS (PARTITION BY entry_key, field ORDER BY version))
WHERE n = 1 OR value IS DISTINCT FROM b""")
def change_log_elided(spark, sf_dir):
    """Daily values of events without the days on which nothing changed."""
    return diff.elide_unchanged(fx.event_cells(spark, sf_dir))


@query(f"""WITH {fx.CELLS_SQL} SELECT entry_key, field, max(version) AS version, arg_max(value, version) AS value FROM cells WHERE version <= 20240115 GROUP BY ALL""")
def asof_state(spark, sf_dir):
    """The newest value of each user and type of event as of a day."""
    return asof.newest_cells(fx.event_cells(spark, sf_dir), None, 20240115).select("entry_key", "field", "version", "value")


@query(f"""WITH {fx.CELLS_SQL}, s AS (SELECT entry_key, field, max(version) AS version FROM cells WHERE version BETWEEN 20240105 AND 20240120 GROUP BY ALL)
SELECT entry_key, count(*) AS n_fields, max(CASE WHEN field = 'click' THEN version END) AS click_version, max(CASE WHEN field = 'error' THEN version END) AS error_version,
  bool_or(field = 'view') AS has_view FROM s GROUP BY entry_key""")
def asof_wide(spark, sf_dir):
    """Entries in wide form within a window of days: fields and field versions looked up by name."""
    cells = asof.in_window(fx.event_cells(spark, sf_dir), 20240105, 20240120).withColumn("value", F.col("value").cast("string")).withColumn("is_tombstone", F.lit(False))
    of = lambda f: F.element_at("versions", F.lit(f))
    return asof.state(cells, 20240120).select(
        "entry_key", F.size("fields").cast("long").alias("n_fields"), of("click").alias("click_version"), of("error").alias("error_version"),
        F.map_contains_key("fields", "view").alias("has_view"))


@query(f"""WITH {fx.RELEASES_SQL}, {fx.PRESENCE_SQL} SELECT entry_key FROM presence WHERE version BETWEEN 2 AND 3 GROUP BY entry_key HAVING max(version) < 3""")
def deleted_in_window(spark, sf_dir):
    """Entries of release 2 that release 3 no longer has."""
    return asof.deleted_in_window(fx.release_presence(spark, sf_dir), 2, 3)


@query(f"""WITH {fx.RELEASES_SQL}, p AS (SELECT c.*, coalesce(b.entry_key, a.entry_key) AS k, CASE WHEN b.entry_key IS NOT NULL THEN b.text ELSE a.text END AS old_text,
  CASE WHEN b.entry_key IS NOT NULL THEN b.source ELSE a.source END AS old_source FROM r3 c LEFT JOIN r2 b ON b.entry_key = c.entry_key LEFT JOIN r1 a ON a.entry_key = c.entry_key)
SELECT entry_key, md5(text) AS text_md5, lang, source FROM p WHERE text IS DISTINCT FROM old_text OR source IS DISTINCT FROM old_source""")
def incremental_get(spark, sf_dir):
    """Entries whose text or source changed in release 3, complete as of it."""
    found = asof.incremental(fx.release_cells(spark, sf_dir), fx.release_presence(spark, sf_dir), 3, 3, ("text", "source"))
    of = lambda f: F.element_at("fields", F.lit(f))
    return found.select("entry_key", F.md5(of("text")).alias("text_md5"), of("lang").alias("lang"), of("source").alias("source"))


@query(f"""WITH {fx.RELEASES_SQL} SELECT entry_key, md5('>' || entry_key || chr(10) || replace(replace(replace(replace(text, ' ', ''), chr(10), ''), chr(13), ''), chr(0), '')) AS fasta_md5,
  length(replace(replace(text, ' ', ''), chr(10), '')) AS n_bases FROM r3""")
def full_get_fasta(spark, sf_dir):
    """Release 3 from its cells, rendered as FASTA, one row per key."""
    entries = asof.incremental(fx.release_cells(spark, sf_dir), fx.release_presence(spark, sf_dir), None, 3, (), complete=True)
    named = entries.select("entry_key", F.create_map(F.lit("ID"), F.concat(F.lit(">"), "entry_key"), F.lit("SEQ"), F.element_at("fields", F.lit("text"))).alias("fields"),
                           F.lit("r").alias("run_id"), F.lit("0000").alias("task_id"))
    text = sinks.first_per_key(formats.FORMATS["fasta"].rendered(named))
    return text.select("entry_key", F.md5("text").alias("fasta_md5"), F.length(F.substring_index("text", "\n", -1)).cast("long").alias("n_bases"))


@query("""SELECT count_if(hit) AS entries, count_if(NOT hit) AS non_matching FROM (SELECT regexp_full_match(lang, 'e.', 'is') AND regexp_full_match(source, 'SRC1[0-5]?', 'is') AS hit
  FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL)""")
def regex_filter(spark, sf_dir):
    """Entries that match patterns on two fields, and those that do not."""
    return filters.filter_counts(fx.table(spark, sf_dir, "documents"), filters.parse_filter("lang=e.,source=SRC1[0-5]?"))


@query("""SELECT doc_id, lang, source FROM documents WHERE regexp_full_match(lang, 'fr|de', 'is') AND regexp_full_match(text, '.*(qui|que) .*|.* und .*', 'is')""")
def regex_filter_rows(spark, sf_dir):
    """Entries whose whole text matches a pattern across lines, in any case."""
    return fx.table(spark, sf_dir, "documents").where(filters.matches({"lang": "fr|de", "text": ".*(qui|que) .*|.* und .*"})).select("doc_id", "lang", "source")


@query("""SELECT o_orderkey, CAST(o_custkey % 12 AS VARCHAR) AS run_id, lpad(CAST(o_custkey % 3 AS VARCHAR), 4, '0') AS task_id FROM orders WHERE o_custkey % 12 = 1 AND o_custkey % 3 = 1""")
def run_task_scope(spark, sf_dir):
    """Entries of run 1 and task 1; run 10 and 11 are other runs."""
    rows = fx.table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 12).cast("string").alias("run_id"), task_key(F.col("o_custkey") % 3).alias("task_id"))
    return filters.in_scope(rows, 1, 1)


@query(f"""WITH {fx.VERSIONS_SQL}, asked AS (SELECT DISTINCT o_orderpriority AS collection, CAST(o_custkey % 5 AS VARCHAR) AS run_id, lpad(CAST(o_custkey % 3 AS VARCHAR), 4, '0') AS task_id FROM orders),
own AS (SELECT collection, run_id, task_id, max(version) AS v FROM versions GROUP BY ALL), shared AS (SELECT collection, max(version) AS s FROM versions GROUP BY ALL)
SELECT q.collection, q.run_id, q.task_id, coalesce(v, s) AS version FROM asked q LEFT JOIN own USING (collection, run_id, task_id) LEFT JOIN shared USING (collection)""")
def latest_version_fallback(spark, sf_dir):
    """Latest version for each run and task; run 4 has none and gets the collection's."""
    asked = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("collection"), (F.col("o_custkey") % 5).cast("string").alias("run_id"), task_key(F.col("o_custkey") % 3).alias("task_id")).distinct()
    return lineage.latest_versions(asked, fx.order_versions(spark, sf_dir))


@query(f"""WITH {fx.RUNS_SQL}, latest AS (SELECT collection, max(version) AS stop FROM runs GROUP BY 1), past AS (SELECT * FROM runs WHERE CAST(run_id AS INT) % 7 <> 0),
last AS (SELECT run_id, collection, arg_max(version, (recorded_at, version)) AS v FROM past GROUP BY ALL)
SELECT q.run_id, q.collection, coalesce(v + 1, 1) AS start, stop, CASE WHEN coalesce(v + 1, 1) > stop THEN 'unchanged' ELSE 'new' END AS status
FROM (SELECT DISTINCT run_id, collection FROM runs) q LEFT JOIN last USING (run_id, collection) LEFT JOIN latest USING (collection)""")
def incremental_window(spark, sf_dir):
    """The versions each run is due, and whether there is anything new."""
    runs = fx.event_runs(spark, sf_dir)
    latest = runs.groupBy("collection").agg(F.max("version").alias("version"))
    return lineage.incremental_windows(runs.select("run_id", "collection").distinct(), runs.where("cast(run_id as int) % 7 <> 0"), latest)


@query(f"""WITH {fx.RUNS_SQL} SELECT run_id, collection AS file, max(CASE WHEN version % 2 = 0 THEN 'put' ELSE 'get' END) AS type, CAST(max(version) AS VARCHAR) AS db_timestamp,
  max(collection || '.txt') AS filename, CAST(NULL AS VARCHAR) AS regex FROM runs GROUP BY ALL""")
def lineage_pivot(spark, sf_dir):
    """Lineage columns of each run as one record per file."""
    runs = fx.event_runs(spark, sf_dir)
    cells = F.array(
        F.struct(F.col("collection").alias("column"), F.when(F.col("version") % 2 == 0, "put").otherwise("get").alias("value")),
        F.struct(F.concat("collection", F.lit("_db_timestamp")).alias("column"), F.col("version").cast("string").alias("value")),
        F.struct(F.concat("collection", F.lit("_filename")).alias("column"), F.concat("collection", F.lit(".txt")).alias("value")),
    )
    return lineage.suffixed_lineage(runs.select("run_id", F.explode(cells).alias("c")).select("run_id", "c.column", "c.value"))


@query(f"""WITH {fx.RUNS_SQL} SELECT run_id, collection, arg_max(CASE WHEN version % 2 = 0 THEN 'put' ELSE 'get' END, (recorded_at, version)) AS direction,
  arg_max(version, (recorded_at, version)) AS version, arg_max(collection || version, (recorded_at, version)) AS path, count(*) AS n_records FROM runs GROUP BY ALL""")
def lineage_report(spark, sf_dir):
    """What each run last got or put of each collection."""
    runs = fx.event_runs(spark, sf_dir).withColumn("direction", F.when(F.col("version") % 2 == 0, "put").otherwise("get"))
    return lineage.lineage_report(runs.withColumn("path", F.concat("collection", "version")).withColumn("regex", F.lit(None).cast("string"))).drop("regex")


@query(f"""WITH {fx.RELEASES_SQL}, {fx.PRESENCE_SQL}, inc AS (SELECT c.entry_key FROM r3 c LEFT JOIN r2 b ON b.entry_key = c.entry_key LEFT JOIN r1 a ON a.entry_key = c.entry_key
  WHERE c.text IS DISTINCT FROM CASE WHEN b.entry_key IS NOT NULL THEN b.text ELSE a.text END)
SELECT 'documents' AS table_name, (SELECT count(*) FROM inc) AS inc_entries, (SELECT count(DISTINCT entry_key) FROM presence WHERE version = 3) AS full_entries,
  (SELECT count(*) FROM (SELECT entry_key FROM presence WHERE version BETWEEN 3 AND 3 GROUP BY 1 HAVING max(version) < 3)) AS deleted_entries, 'FASTA' AS type, 'human' AS taxon""")
def get_metadata(spark, sf_dir):
    """Metadata of an incremental get."""
    presence = fx.release_presence(spark, sf_dir)
    existing = asof.incremental(fx.release_cells(spark, sf_dir), presence, 3, 3, ("text",))
    return counts.get_metadata(existing, presence, 3, 3, "documents", "FASTA", "human")


@query(f"""WITH {fx.RELEASES_SQL} SELECT (SELECT count(*) FROM r2) AS n_entries, (SELECT count(*) FROM r2 WHERE entry_key NOT IN (SELECT entry_key FROM r1)) AS n_new,
  (SELECT count(*) FROM r1 a JOIN r2 b ON a.entry_key = b.entry_key WHERE a.text IS DISTINCT FROM b.text OR a.lang IS DISTINCT FROM b.lang OR a.source IS DISTINCT FROM b.source) AS n_modified,
  (SELECT count(*) FROM r1 WHERE entry_key NOT IN (SELECT entry_key FROM r2)) AS n_deleted""")
def ingest_counters(spark, sf_dir):
    """Counters of putting release 2 on release 1."""
    return counts.ingest_counters(diff.entry_changes(fx.release(spark, sf_dir, 1), fx.release(spark, sf_dir, 2)))


@query(f"""WITH {fx.RUNS_SQL} SELECT DISTINCT collection, version, concat_ws('_', collection, '1', CAST(version AS VARCHAR), md5('ID=.*'), 'add', '4') || concat_ws('_', '', run_id, '0001') AS cache_key FROM runs""")
def cache_key_of_request(spark, sf_dir):
    """Names under which the results of requests are kept."""
    lit = F.lit
    key = cache_key(F.col("collection"), lit(1), F.col("version"), lit("ID=.*"), lit("add"), lit(4), F.col("run_id"), lit("0001"), lit(False))
    return fx.event_runs(spark, sf_dir).select("collection", "version", key.alias("cache_key")).distinct()


@query(f"""WITH {fx.FILES_SQL}, {fx.FILES2_SQL} SELECT f.path, f.hash FROM files f UNION ALL SELECT g.path, g.hash FROM files2 g WHERE g.path NOT IN (SELECT path FROM files)""")
def path_append(spark, sf_dir):
    """Paths of a second load added to those of the first without repeats."""
    first, second = (fx.page_files(spark, sf_dir, n).select("path", "hash") for n in (1, 2))
    return lineage.append_paths(first, second)


@query("""SELECT CAST(doc_id AS VARCHAR) AS entry_key, lang FROM documents""")
def split_assignment(spark, sf_dir):
    """Entries dealt to four files by key, in order; every row is in one of them."""
    rows = fx.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("entry_key"), "lang")
    return sinks.split_sorted(rows, 4)


@query("""SELECT doc_id AS file, n - 1 AS ordinal, trim(line, ' ') AS header, strlen(line) AS n_bytes FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents)""")
def record_split(spark, sf_dir):
    """Records cut at lines that match a start pattern: documents whose lines each head a record."""
    docs = fx.table(spark, sf_dir, "documents")
    text = F.concat(F.lit("skipped\n>"), F.replace("text", F.lit("\n"), F.lit("\n//\n>")), F.lit("\n//\n"))
    cut = records.cut_by_pattern(docs.select(F.col("doc_id").alias("file"), text.alias("value")), ">[^\n]*", "//")
    rank = F.row_number().over(Window.partitionBy("file").orderBy("ordinal")) - 1
    line = F.substr("record", F.lit(2))
    return cut.select("file", rank.cast("long").alias("ordinal"), F.trim(line).alias("header"), F.octet_length(line).cast("long").alias("n_bytes"))


@query("""SELECT count(*) AS n_entries FROM documents""")
def count_entries(spark, sf_dir):
    """Entries of the documents as FASTA lines."""
    docs = fx.table(spark, sf_dir, "documents")
    lines = docs.select(F.explode(F.array(F.concat(F.lit(">"), F.col("doc_id")), F.replace("text", F.lit(">"), F.lit("")))).alias("value"))
    return counts.count_records(lines)


@query("""WITH c AS (SELECT conv_id, turn, CASE role WHEN 'system' THEN 'ID' WHEN 'user' THEN 'DE' ELSE 'SE' END AS code, text FROM conversations)
SELECT conv_id, code, md5(string_agg(text, chr(10) ORDER BY turn)) AS text_md5, count(*) AS n_lines FROM c GROUP BY ALL""")
def uniprot_fields(spark, sf_dir):
    """Coded lines of each entry gathered into fields; a blank code is the sequence."""
    code = F.when(F.col("role") == "system", "ID").when(F.col("role") == "user", "DE").otherwise("  ")
    rows = fx.table(spark, sf_dir, "conversations").select("conv_id", F.struct("turn", code.alias("code"), "text").alias("line"))
    entries = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    name = lambda x: F.when(F.trim(x["code"]) == "", "SE").otherwise(x["code"])
    fields = formats.coded_fields(F.col("lines"), name, lambda x: x["text"])
    out = entries.select("conv_id", "lines", F.explode(F.map_filter(fields, lambda k, v: k != "#order")).alias("code", "text"))
    return out.select("conv_id", "code", F.md5("text").alias("text_md5"), F.size(F.filter("lines", lambda x: name(x) == F.col("code"))).cast("long").alias("n_lines"))


@query("""SELECT conv_id, md5(string_agg(role || ' ' || text, chr(10) ORDER BY turn)) AS profile_md5, count(*) AS n_lines FROM conversations GROUP BY conv_id""")
def profile_lines(spark, sf_dir):
    """Ordered lines kept under ordinals, and rendered in their order again."""
    rows = fx.table(spark, sf_dir, "conversations").select("conv_id", F.struct("turn", F.concat_ws(" ", "role", "text").alias("line")).alias("x"))
    entries = rows.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["line"]).alias("lines"))
    kept = entries.select("conv_id", F.size("lines").cast("long").alias("n_lines"), formats.ordinal_lines(F.col("lines"), lambda x: F.substring(x, 1, 4)).alias("fields"))
    return kept.select("conv_id", F.md5(formats.lines_in_order(F.col("fields"))).alias("profile_md5"), "n_lines")


@query("""WITH l AS (SELECT source AS file, unnest(string_split(text, chr(10))) AS line FROM documents), b AS (SELECT file, sum(length(trim(line, ' '))) AS base_pairs FROM l GROUP BY file),
c AS (SELECT source AS file, count(*) AS contigs FROM documents GROUP BY 1)
SELECT file, CAST(base_pairs AS BIGINT) AS base_pairs, contigs, 1 AS files, CAST(base_pairs // contigs AS BIGINT) AS mean_length FROM b JOIN c USING (file)
UNION ALL SELECT NULL, CAST(sum(base_pairs) AS BIGINT), CAST(sum(contigs) AS BIGINT), count(*), CAST(sum(base_pairs) // sum(contigs) AS BIGINT) FROM b JOIN c USING (file)""")
def corpus_base_pairs(spark, sf_dir):
    """Base pairs, contigs and mean length per source and in total."""
    docs = fx.table(spark, sf_dir, "documents")
    lines = docs.select(F.col("source").alias("file"), F.explode(F.concat(F.array(F.concat(F.lit(">"), F.col("doc_id"))), F.transform(F.split("text", "\n"), lambda x: F.translate(x, ">", "+")))).alias("value"))
    return counts.base_pairs(lines)


_CORRECT = """kept AS (SELECT *, e_value * (SELECT count(*) FROM lineitem) / (SELECT count(*) FROM lineitem WHERE l_linenumber <= 3) AS scaled FROM hits
  WHERE subject_id NOT IN (SELECT 's' || (p_partkey % 97) FROM part WHERE p_partkey % 97 IN (3, 14, 15)))"""


@query(f"""WITH {fx.HITS_SQL}, {_CORRECT}
SELECT query_id, line_no, subject_id, round(scaled, 8) AS e_value, q_stop - query_start AS query_len, s_stop - s_start AS subject_len, q_stop - query_start - mismatches AS identical,
  q_stop - query_start - mismatches - gaps AS positive FROM kept""")
def blast_correct(spark, sf_dir):
    """Hits on subjects that are still there, with e-values of the full collection."""
    rows = fx.line_hits(spark, sf_dir)
    sizes = fx.table(spark, sf_dir, "lineitem").agg(F.count("*").alias("full_n"), F.count_if(F.col("l_linenumber") <= 3).alias("inc_n"))
    found = hits.correct(rows.crossJoin(F.broadcast(sizes)), fx.deleted_subjects(spark, sf_dir), F.col("full_n"), F.col("inc_n"))
    return found.select("query_id", "line_no", "subject_id", F.round("e_value", 8).alias("e_value"), "query_len", "subject_len", "identical", "positive")


def _plain(lines: DataFrame) -> DataFrame:
    """Hits without the columns that only their numbering needs, so that these are not written."""
    return lines.drop("l_orderkey", "l_partkey", "l_suppkey")


@query(f"""WITH {fx.HITS_SQL}, marked AS (SELECT *, CASE WHEN row_number() OVER w = 1 THEN 1 WHEN q_stop - query_start = lag(q_stop - query_start) OVER w AND subject_id = lag(subject_id) OVER w
  AND s_stop - s_start = lag(s_stop - s_start) OVER w THEN 0 ELSE 1 END AS new FROM hits WINDOW w AS (PARTITION BY query_id ORDER BY line_no)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY query_id ORDER BY line_no) AS island FROM marked),
firsts AS (SELECT *, first_value((identity, align_length, mismatches, gaps, e_value, hit)) OVER (PARTITION BY query_id, island ORDER BY line_no) AS f FROM numbered),
kept AS (SELECT * FROM firsts WHERE (identity, align_length, mismatches, gaps, e_value, hit) = f), q AS (SELECT query_id, row_number() OVER (ORDER BY min(l_orderkey)) AS iteration_no FROM hits GROUP BY query_id)
SELECT query_id, line_no, subject_id, iteration_no, dense_rank() OVER (PARTITION BY query_id ORDER BY island) AS hit_no, row_number() OVER (PARTITION BY query_id, island ORDER BY line_no) - 1 AS hsp_no
FROM kept JOIN q USING (query_id)""")
def blast_islands(spark, sf_dir):
    """Hits in reading order with iteration, hit and HSP numbers."""
    lines = fx.line_hits(spark, sf_dir)
    rows = hits.iterations(hits.islands(_plain(lines)), ("l_orderkey", "line_no"), lines)
    as_long = [F.col(c).cast("long").alias(c) for c in ("iteration_no", "hit_no", "hsp_no")]
    return rows.select("query_id", "line_no", "subject_id", *as_long)


@query(f"""WITH {fx.HITS_SQL}, marked AS (SELECT *, CASE WHEN row_number() OVER w = 1 THEN 1 WHEN q_stop - query_start = lag(q_stop - query_start) OVER w AND subject_id = lag(subject_id) OVER w
  AND s_stop - s_start = lag(s_stop - s_start) OVER w THEN 0 ELSE 1 END AS new FROM hits WINDOW w AS (PARTITION BY query_id ORDER BY line_no)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY query_id ORDER BY line_no) AS island FROM marked), q AS (SELECT query_id, row_number() OVER (ORDER BY min(l_orderkey)) AS iteration_no FROM hits GROUP BY query_id)
SELECT iteration_no, query_id, island AS hit_no, subject_id, s_stop - s_start AS subject_len, row_number() OVER (PARTITION BY query_id, island ORDER BY line_no) - 1 AS hsp_no,
  hit AS bit_score, e_value, q_stop - query_start - mismatches AS identical, q_stop - query_start - mismatches - gaps AS positive, align_length FROM numbered JOIN q USING (query_id)""")
def blast_nested_xml(spark, sf_dir):
    """The report of the hits nested as its XML is, one row per innermost element."""
    lines = fx.line_hits(spark, sf_dir)
    nested = hits.nested(hits.iterations(hits.islands(_plain(lines), keep="all_hsps"), ("l_orderkey", "line_no"), lines))
    found = nested.select(F.col("`Iteration_iter-num`").alias("iteration_no"), F.col("`Iteration_query-def`").alias("query_id"), F.explode("Iteration_hits.Hit").alias("h"))
    each = found.select("iteration_no", "query_id", "h", F.explode("h.Hit_hsps.Hsp").alias("p"))
    return each.select(
        "iteration_no", "query_id", F.col("h.Hit_num").cast("long").alias("hit_no"), F.col("h.Hit_def").alias("subject_id"), F.col("h.Hit_len").alias("subject_len"),
        F.col("p.Hsp_num").cast("long").alias("hsp_no"), F.col("p.Hsp_score").alias("bit_score"), F.col("p.Hsp_evalue").alias("e_value"),
        F.col("p.Hsp_identity").alias("identical"), F.col("p.Hsp_positive").alias("positive"), F.col("p")["Hsp_align-len"].alias("align_length"))


def _fullest(files: DataFrame, folder: Column) -> str:
    """The folder of ``files`` that holds most live ones; of equal ones the first by name."""
    return manifest.live(files).groupBy(folder.alias("folder")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "folder").first().folder


_FOLDER = "(SELECT regexp_replace(path, '/?[^/]*$', '') AS f FROM files WHERE NOT is_deleted GROUP BY f ORDER BY count(*) DESC, f LIMIT 1)"
_HOST = "(SELECT split_part(path, '/', 1) AS f FROM files WHERE NOT is_deleted GROUP BY f ORDER BY count(*) DESC, f LIMIT 1)"


@query(f"""WITH {fx.FILES_SQL}, o AS (SELECT *, f || '/' AS base FROM files, {_FOLDER}) SELECT path, size, substr(path, length(base) + 1) AS suffix FROM o
  WHERE NOT is_deleted AND starts_with(path, base) AND NOT contains(substr(path, length(base) + 1), '/')""")
def ls(spark, sf_dir):
    """Files directly in the folder that has most."""
    found = fx.page_files(spark, sf_dir)
    return manifest.ls(found, _fullest(found, text.path_parent(F.col("path")))).select("path", "size", "suffix")


@query(f"""WITH {fx.FILES_SQL}, o AS (SELECT *, f || '/' AS base FROM files, {_HOST}) SELECT path, size, substr(path, length(base) + 1) AS suffix FROM o WHERE NOT is_deleted AND starts_with(path, base)""")
def ls_rec(spark, sf_dir):
    """All files below the host that has most."""
    found = fx.page_files(spark, sf_dir)
    return manifest.ls_rec(found, _fullest(found, F.substring_index("path", "/", 1))).select("path", "size", "suffix")


@query(f"""WITH {fx.FILES_SQL} SELECT max(size) AS size FROM files WHERE NOT is_deleted AND path = (SELECT min(path) FROM files WHERE NOT is_deleted)""")
def file_size(spark, sf_dir):
    """Size of the first live file."""
    files = fx.page_files(spark, sf_dir)
    first = manifest.live(files).agg(F.min("path").alias("path"))
    return manifest.live(files).join(first, "path").agg(F.max("size").alias("size"))


@query(f"""WITH {fx.FILES_SQL} SELECT path, hash FROM files WHERE NOT is_deleted AND contains(path, '/fr/')""")
def get_files(spark, sf_dir):
    """Live files whose path contains a part."""
    return manifest.get_files(fx.page_files(spark, sf_dir), "/fr/").select("path", "hash")


@query(f"""WITH {fx.FILES_SQL}, folders AS (SELECT DISTINCT split_part(path, '/', 1) || '/' || split_part(path, '/', 2) AS path FROM files WHERE contains(path, '/en/')
  UNION SELECT DISTINCT split_part(path, '/', 1) FROM files WHERE contains(path, '/fr/')),
asked AS (SELECT path || '/x' AS path FROM files)
SELECT a.path, (SELECT arg_max(f.path, length(f.path)) FROM folders f WHERE a.path = f.path OR starts_with(a.path, f.path || '/')) AS super_path FROM asked a""")
def super_path(spark, sf_dir):
    """The nearest existing ancestor of each path."""
    files = fx.page_files(spark, sf_dir)
    parts = F.split("path", "/")
    folders = files.where(F.col("path").contains("/en/")).select(F.concat_ws("/", parts[0], parts[1]).alias("path")).union(
        files.where(F.col("path").contains("/fr/")).select(parts[0].alias("path"))).distinct()
    return manifest.super_paths(files.select(F.concat("path", F.lit("/x")).alias("path")), folders)


@query(f"""WITH {fx.FILES_SQL}, {fx.FILES2_SQL} SELECT n.path, n.size, CASE WHEN o.hash = n.hash THEN 'unchanged' WHEN o.hash IS NULL THEN 'new' ELSE 'replaced' END AS state,
  o.version AS old_version FROM files2 n LEFT JOIN files o ON o.path = n.path""")
def hash_dedup(spark, sf_dir):
    """A second load of files: those of equal hash keep the stored copy."""
    return manifest.put_files(fx.page_files(spark, sf_dir), fx.page_files(spark, sf_dir, 2)).select("path", "size", "state", "old_version")


@query(f"""WITH {fx.FILES_SQL}, h AS {_HOST}, one AS (SELECT min(path) AS p FROM files WHERE NOT is_deleted AND NOT starts_with(path, (SELECT f || '/' FROM h))),
marked AS (SELECT path, version, is_deleted, starts_with(path, f || '/') OR path IS NOT DISTINCT FROM p AS hit FROM files, h, one)
SELECT path, CASE WHEN hit THEN 7 ELSE version END AS version, is_deleted OR hit AS is_deleted FROM marked""")
def soft_delete(spark, sf_dir):
    """The files of a host, and one other, marked deleted at a version."""
    found = fx.page_files(spark, sf_dir)
    host = _fullest(found, F.substring_index("path", "/", 1))
    one = manifest.live(found).where(~F.col("path").startswith(host + "/")).agg(F.min("path").alias("path")).first().path
    gone = manifest.soft_delete(manifest.soft_delete(found, host, 7, tree=True), one or "", 7)
    return gone.select("path", F.col("version").cast("long").alias("version"), "is_deleted")


@query(f"""WITH {fx.RELEASES_SQL} SELECT 'deleted' AS kind, count(*) AS n FROM r2 WHERE entry_key NOT IN (SELECT entry_key FROM r3)
UNION ALL SELECT 'existing', count(*) FROM r3 UNION ALL SELECT 'metadata', 1""")
def result_parts(spark, sf_dir):
    """The parts of a get in one table, counted by kind."""
    presence = fx.release_presence(spark, sf_dir)
    existing = asof.present_at(presence, 3)
    parts = {"existing": existing, "deleted": asof.deleted_in_window(presence, 2, 3), "metadata": existing.agg(F.count("*").cast("string").alias("entry_key"))}
    return sinks.concatenate(parts).groupBy("kind").agg(F.count("*").alias("n"))


def _store(spark: SparkSession, sf_dir: str, *order: int) -> Store:
    """A store in a new shared folder with the releases of documents put under versions 1 to 3, in any order."""
    store = Store(spark, shared_folder(spark), {"documents": DOCUMENTS})
    for version in order:
        fields = F.map_concat("fields", F.create_map(F.lit("ID"), F.concat(F.lit(">"), "entry_key")))
        store.put(fx.release(spark, sf_dir, version).select("entry_key", fields.alias("fields")), "documents", version, "documents")
    return store


#: Documents as a format of the store: text and source make a change count.
DOCUMENTS = formats.Format(
    "documents", "\n", lambda r: F.create_map(F.lit("ID"), r), {"LINE": lambda f, a: F.concat_ws("|", F.element_at(f, F.lit("ID")), F.element_at(f, F.lit("source")), F.element_at(f, F.lit("lang")))},
    {"LINE": ("text", "source")}, default_type="LINE")

_LINE = "concat_ws('|', '>' || c.entry_key, c.source, c.lang)"


@query(f"""WITH {fx.RELEASES_SQL} SELECT entry_key, {_LINE} AS text, md5(c.text) AS text_md5 FROM r3 c""")
def store_full_get(spark, sf_dir):
    """Three releases put in order, and the last read whole."""
    got = _store(spark, sf_dir, 1, 2, 3).get("documents", start=1, full_run=True)
    return got.existing.select("entry_key", "text", F.md5(F.element_at("fields", F.lit("text"))).alias("text_md5"))


@query(f"""WITH {fx.RELEASES_SQL} SELECT entry_key, {_LINE} AS text, md5(c.text) AS text_md5 FROM r2 c""")
def store_back_fill(spark, sf_dir):
    """Releases put out of order, one of them twice, and the middle one read as of its version."""
    got = _store(spark, sf_dir, 3, 1, 2, 1).get("documents", start=1, stop=2)
    return got.existing.select("entry_key", "text", F.md5(F.element_at("fields", F.lit("text"))).alias("text_md5"))


@query(f"""WITH {fx.RELEASES_SQL}, p AS (SELECT c.*, CASE WHEN b.entry_key IS NOT NULL THEN b.text ELSE a.text END AS old_text,
  CASE WHEN b.entry_key IS NOT NULL THEN b.source ELSE a.source END AS old_source FROM r3 c LEFT JOIN r2 b ON b.entry_key = c.entry_key LEFT JOIN r1 a ON a.entry_key = c.entry_key)
SELECT 'existing' AS kind, entry_key, {_LINE} AS text FROM p c WHERE c.text IS DISTINCT FROM old_text OR c.source IS DISTINCT FROM old_source
UNION ALL SELECT 'full', CAST(count(*) AS VARCHAR), NULL FROM r3""")
def store_incremental_export(spark, sf_dir):
    """A run exports release 2 and then what is new; the export is kept and served again."""
    store = _store(spark, sf_dir, 1, 2)
    store.export("documents", run_id="7")
    fields = F.map_concat("fields", F.create_map(F.lit("ID"), F.concat(F.lit(">"), "entry_key")))
    store.put(fx.release(spark, sf_dir, 3).select("entry_key", fields.alias("fields")), "documents", 3, "documents")
    result, kept = store.export("documents", run_id="7", split=4)
    assert store.export("documents", start=3, stop=3, run_id="8", split=4)[1] == kept and store.get("documents", run_id="7").status == "unchanged"
    rows = spark.read.parquet(kept).select(F.lit("existing").alias("kind"), "entry_key", "text")
    return rows.unionByName(result.metadata.select(F.lit("full").alias("kind"), F.col("full_entries").cast("string").alias("entry_key"), F.lit(None).cast("string").alias("text")))


@query(f"""WITH {fx.RELEASES_SQL} SELECT entry_key, {_LINE} AS text FROM r3 c WHERE lang = 'fr' AND regexp_full_match(source, 'src1.*', 'is')""")
def store_compacted_filter(spark, sf_dir):
    """A filtered read after the history was folded into a snapshot."""
    store = _store(spark, sf_dir, 1, 2, 3)
    store.compact("documents", 3)
    return store.get("documents", start=1, regex={"lang": "fr", "source": "SRC1.*"}).existing.select("entry_key", "text")


@query("""SELECT 'put' AS direction, v AS version, CAST(NULL AS VARCHAR) AS run_id, n FROM (
  SELECT 1 AS v, count_if(doc_id % 10 <> 3) AS n FROM documents UNION ALL SELECT 2, count_if(doc_id % 10 <> 7) FROM documents) UNION ALL SELECT 'get', 2, '7', NULL""")
def store_lineage(spark, sf_dir):
    """What a store records of its puts and gets, with the entries of each version."""
    store = _store(spark, sf_dir, 1, 2)
    store.export("documents", run_id="7")
    runs = store.table("runs").select("direction", "version", F.nullif("run_id", F.lit("")).alias("run_id"))
    entries = store.table("versions").select("version", F.lit("put").alias("direction"), F.col("entries").alias("n"))
    return runs.join(entries, ["version", "direction"], "left").select("direction", "version", "run_id", "n")


def _through_files(spark: SparkSession, lines: DataFrame, name: str) -> DataFrame:
    """Text written as files and read again as entries of a format."""
    folder = shared_folder(spark)
    lines.select("value").write.text(folder)
    return formats.FORMATS[name].read(spark, folder)


@query("""SELECT '>' || doc_id AS entry_key, md5(replace(replace(replace(text, '>', ''), chr(13), ''), chr(10), '')) AS seq_md5 FROM (
  SELECT doc_id, string_agg(regexp_replace(regexp_replace(line, '^[\x00-\x20]+', ''), '[\x00-\x20]+$', ''), '' ORDER BY n) AS text FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM (SELECT doc_id, replace(text, '>', '') AS text FROM documents)) GROUP BY doc_id)""")
def fasta_files(spark, sf_dir):
    """Documents written as FASTA with CRLF line ends after a comment, read through the format."""
    body = F.replace(F.replace("text", F.lit(">"), F.lit("")), F.lit("\n"), F.lit("\r\n"))
    docs = fx.table(spark, sf_dir, "documents").select(F.concat(F.lit(">"), "doc_id", F.lit("\r\n"), body, F.lit("\r")).alias("value"), "doc_id")
    comment = spark.range(1).select(F.lit("; a comment\r").alias("value"))
    entries = _through_files(spark, docs.select("value"), "fasta").unionByName(_through_files(spark, comment, "fasta"))
    return entries.select("entry_key", F.md5(F.element_at("fields", F.lit("SEQ"))).alias("seq_md5"))


@query("""WITH c AS (SELECT conv_id, turn, CASE role WHEN 'system' THEN 'AC' WHEN 'user' THEN 'DE' ELSE 'SE' END AS code, replace(replace(text, chr(10), ' '), chr(13), ' ') AS text FROM conversations)
SELECT 'E' || conv_id AS entry_key, code, md5(string_agg(text, chr(10) ORDER BY turn)) AS text_md5 FROM c GROUP BY ALL UNION ALL SELECT DISTINCT 'E' || conv_id, 'ID', md5('E' || conv_id) FROM c""")
def uniprot_files(spark, sf_dir):
    """Conversations written as coded flat files with CRLF line ends, read through the format."""
    code = F.when(F.col("role") == "system", "AC").when(F.col("role") == "user", "DE").otherwise("  ")
    text = F.translate("text", "\n\r", "  ")
    turns = fx.table(spark, sf_dir, "conversations").select("conv_id", F.struct("turn", F.concat(code, F.lit("   "), text, F.lit("\r")).alias("line")).alias("x"))
    lines = turns.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["line"]).alias("lines"))
    entry = F.array_join(F.concat(F.array(F.concat(F.lit("ID   E"), "conv_id", F.lit("\r"))), "lines", F.array(F.lit("//\r"))), "\n")
    entries = _through_files(spark, lines.select(entry.alias("value")), "uniprot")
    fields = entries.select("entry_key", F.explode(F.map_filter("fields", lambda k, v: k != "#order")).alias("code", "text"))
    return fields.select("entry_key", "code", F.md5("text").alias("text_md5"))


@query(f"""WITH {fx.HITS_SQL} SELECT query_id, subject_id, count(*) AS n, sum(align_length) AS align_length, max(e_value) AS e_value FROM hits GROUP BY ALL""")
def blast_files(spark, sf_dir):
    """Search hits written as tab-separated lines, some of them broken, and read again."""
    rows = fx.line_hits(spark, sf_dir).select("line_no", F.concat_ws("\t", *[F.col(c).cast("string") for c in hits.HIT_COLUMNS]).alias("value"))
    folder = shared_folder(spark)
    broken = rows.where("line_no = 1").select(F.substring_index("value", "\t", 4).alias("value"))
    rows.select("value").unionByName(broken).write.text(folder)
    found = files.read_hits(spark, folder)
    return found.groupBy("query_id", "subject_id").agg(F.count("*").alias("n"), F.sum("align_length").alias("align_length"), F.max("e_value").alias("e_value"))


@query("""SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS size, sha256(html) AS hash FROM pages""")
def copied_files(spark, sf_dir):
    """Pages written as files, copied by manifest, and listed again with their size and hash."""
    source, target = shared_folder(spark), shared_folder(spark)
    pages = fx.table(spark, sf_dir, "pages").select(F.concat(F.lit("p/"), F.col("page_id"), F.lit(".html")).alias("path"), F.encode("html", "UTF-8").alias("content"))
    files.write_files(pages, source).count()
    files.copy_files(pages.select("path"), source, target).count()
    back = manifest.from_folder(spark, target, 1)
    return back.select(F.regexp_extract("path", r"(\d+)\.html$", 1).cast("long").alias("page_id"), "size", "hash")


@query(f"""WITH {fx.HITS_SQL}, marked AS (SELECT *, CASE WHEN row_number() OVER w = 1 THEN 1 WHEN q_stop - query_start = lag(q_stop - query_start) OVER w AND subject_id = lag(subject_id) OVER w
  AND s_stop - s_start = lag(s_stop - s_start) OVER w THEN 0 ELSE 1 END AS new FROM hits WINDOW w AS (PARTITION BY query_id ORDER BY line_no)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY query_id ORDER BY line_no) AS island FROM marked),
firsts AS (SELECT *, first_value((identity, align_length, mismatches, gaps, e_value, hit)) OVER (PARTITION BY query_id, island ORDER BY line_no) AS f FROM numbered),
kept AS (SELECT * FROM firsts WHERE (identity, align_length, mismatches, gaps, e_value, hit) = f), q AS (SELECT query_id, row_number() OVER (ORDER BY min(l_orderkey)) AS iteration_no FROM hits GROUP BY query_id)
SELECT iteration_no, query_id, island AS hit_no, subject_id || ' taxon & <1>' AS hit_def, s_stop - s_start AS hit_len, row_number() OVER (PARTITION BY query_id, island ORDER BY line_no) - 1 AS hsp_no,
  align_length, e_value, q_stop - query_start - mismatches AS identical, hit AS score, q_stop AS query_to, 'blastp' AS program FROM kept JOIN q USING (query_id)""")
def report_document(spark, sf_dir):
    """The report as one XML document, written by many tasks and read again."""
    lines, path = fx.line_hits(spark, sf_dir), f"{shared_folder(spark)}/report.xml"
    # an order key is of one query, so that the least ones number the queries
    sinks.write_report(hits.iterations(hits.islands(_plain(lines)), ("l_orderkey",), lines), path, "blastp", "taxon & <1>")
    kept = ("iteration_no", "query_id", "hit_no", "hit_def", "hit_len", "hsp_no", "align_length", "e_value", "identical")
    return files.read_report(spark, path).select(*kept, F.col("hit").alias("score"), F.col("q_stop").alias("query_to"), "program")


@query(f"""WITH {fx.RELEASES_SQL} SELECT entry_key, {_LINE} AS text FROM r2 c""")
def store_snapshot(spark, sf_dir):
    """A get made before its version is put again and folded, and read afterwards."""
    store = _store(spark, sf_dir, 1, 2)
    got = store.get("documents", start=1)
    fields = F.map_concat("fields", F.create_map(F.lit("ID"), F.concat(F.lit(">"), "entry_key")))
    store.put(fx.release(spark, sf_dir, 3).select("entry_key", fields.alias("fields")), "documents", 2, "documents")
    store.compact("documents", 2)
    return got.existing.select("entry_key", "text")


@query(f"""WITH {fx.RELEASES_SQL} SELECT text, NULL AS rows FROM (SELECT {_LINE} AS text FROM r2 c) UNION ALL SELECT 'noted', count(*) FROM r2""")
def store_export_path(spark, sf_dir):
    """A result written to a path of the caller's, its lines, and the rows noted for it."""
    store, path = _store(spark, sf_dir, 1, 2), shared_folder(spark)
    for _ in range(2):  # the second is answered from the listing
        store.export("documents", path, start=1, split=3)
    noted = store.table("materializations").where(F.col("path") == path).select(F.lit("noted").alias("text"), "rows")
    return spark.read.text(path).select(F.col("value").alias("text"), F.lit(None).cast("long").alias("rows")).unionByName(noted)


def _written(spark: SparkSession, lines: DataFrame, compression: str = "none") -> str:
    """A new folder with the column value of ``lines`` as text files."""
    folder = shared_folder(spark)
    lines.select("value").write.option("compression", compression).text(folder)
    return folder


def _entries(spark: SparkSession, lines: DataFrame, name: str, kind: str | None = None) -> DataFrame:
    """(entry_key, fields, text) of lines written as files, read by a format and rendered by it."""
    fmt = formats.FORMATS[name]
    return fmt.rendered(fmt.read(spark, _written(spark, lines, "gzip")), kind)


_PLAIN = "regexp_replace(replace(replace(text, '>', ''), chr(13), ''), '\\n+$', '')"
_ONE_LINE = "trim(regexp_replace(text, '[\\x00-\\x20]+', ' ', 'g'), ' ')"


@query(f"""SELECT '>' || doc_id AS entry_key, md5('>' || doc_id || chr(10) || {_PLAIN}) AS text_md5 FROM documents""")
def glimmer_files(spark, sf_dir):
    """Documents as records whose lines are kept, through compressed files."""
    plain = F.regexp_replace(F.translate("text", ">\r", ""), "\n+$", "")
    docs = fx.table(spark, sf_dir, "documents").select(F.concat(F.lit(">"), "doc_id", F.lit("\n"), plain).alias("value"))
    return _entries(spark, docs, "glimmer").select("entry_key", F.md5("text").alias("text_md5"))


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, turn, role, text) with texts of one line."""
    return fx.table(spark, sf_dir, "conversations").withColumn("text", F.trim(F.regexp_replace("text", r"[\x00-\x20]+", " ")))


def _gathered(turns: DataFrame, line: Column) -> DataFrame:
    """(conv_id, lines): a line of each turn, in order."""
    return turns.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("line")))), lambda x: x["line"]).alias("lines"))


@query(f"""SELECT 'c' || conv_id AS entry_key, md5('HMMER3/f' || chr(10) || 'NAME  c' || conv_id || chr(10) || string_agg('ACC   ' || role || ' ' || {_ONE_LINE}, chr(10) ORDER BY turn) || chr(10) || '//') AS text_md5
FROM conversations GROUP BY conv_id""")
def profile_files(spark, sf_dir):
    """Conversations as profiles, whose lines keep their order."""
    lines = _gathered(_turns(spark, sf_dir), F.concat(F.lit("ACC   "), "role", F.lit(" "), "text"))
    value = F.array_join(F.concat(F.array(F.lit("HMMER3/f"), F.concat(F.lit("NAME  c"), "conv_id")), "lines", F.array(F.lit("//"))), "\n")
    return _entries(spark, lines.select(value.alias("value")), "hmm").select("entry_key", F.md5("text").alias("text_md5"))


@query(f"""SELECT 'c' || conv_id AS entry_key, md5('# STOCKHOLM 1.0' || chr(10) || '#=GF ID   c' || conv_id || chr(10) || string_agg('#=GF CC   ' || role || ' ' || {_ONE_LINE}, chr(10) ORDER BY turn) || chr(10) || '//') AS text_md5
FROM conversations GROUP BY conv_id""")
def stockholm_files(spark, sf_dir):
    """Conversations as alignments."""
    lines = _gathered(_turns(spark, sf_dir), F.concat(F.lit("#=GF CC   "), "role", F.lit(" "), "text"))
    value = F.array_join(F.concat(F.array(F.lit("# STOCKHOLM 1.0"), F.concat(F.lit("#=GF ID   c"), "conv_id")), "lines", F.array(F.lit("//"))), "\n")
    return _entries(spark, lines.select(value.alias("value")), "pfam").select("entry_key", F.md5("text").alias("text_md5"))


@query(f"""WITH l AS (SELECT conv_id, turn, CASE role WHEN 'system' THEN 'AC' WHEN 'user' THEN 'DE' ELSE 'SE' END AS code, {_ONE_LINE} AS text FROM conversations),
c AS (SELECT conv_id, code, min(turn) AS first, string_agg(CASE code WHEN 'SE' THEN '  ' ELSE code END || '   ' || text, chr(10) ORDER BY turn) AS block, string_agg(replace(text, ' ', ''), '' ORDER BY turn) AS body FROM l GROUP BY conv_id, code)
SELECT 'E' || conv_id AS entry_key, md5('ID   E' || conv_id || chr(10) || string_agg(block, chr(10) ORDER BY first) || chr(10) || '//') AS dat_md5,
  md5('>E' || conv_id || coalesce(chr(10) || max(CASE WHEN code = 'SE' THEN body END), '')) AS fasta_md5 FROM c GROUP BY conv_id""")
def uniprot_rendered(spark, sf_dir):
    """Conversations as flat files, rendered as flat file and as FASTA."""
    code = F.when(F.col("role") == "system", "AC").when(F.col("role") == "user", "DE").otherwise("  ")
    lines = _gathered(_turns(spark, sf_dir), F.concat(code, F.lit("   "), "text"))
    value = F.array_join(F.concat(F.array(F.concat(F.lit("ID   E"), "conv_id")), "lines", F.array(F.lit("//"))), "\n")
    dat = _entries(spark, lines.select(value.alias("value")), "uniprot", "DAT")
    fasta = formats.FORMATS["uniprot"].rendered(dat.select("entry_key", "fields"), "FASTA")
    return dat.select("entry_key", F.md5("text").alias("dat_md5")).join(fasta.select("entry_key", F.md5("text").alias("fasta_md5")), "entry_key")


_HIT_LINE = "concat_ws(chr(9), query_id, subject_id, CAST(round(identity) AS INT), align_length, mismatches, gaps, query_start, q_stop, s_start, s_stop, CAST(round(100 * e_value) AS INT), CAST(round(hit) AS INT))"


@query(f"""WITH {fx.HITS_SQL} SELECT DISTINCT {_HIT_LINE} AS entry_key, {_HIT_LINE} AS text, NULL AS n FROM hits
UNION ALL SELECT 'rejected', 'not a record of the format', count(*) FROM hits WHERE line_no = 1""")
def hit_lines(spark, sf_dir):
    """Hits as tab-separated lines put from files, and how many lines were rejected."""
    whole = lambda c, n=1: F.round(n * F.col(c)).cast("int")
    cells = [whole("identity"), *hits.HIT_COLUMNS[3:10], whole("e_value", 100), whole("hit")]
    rows = fx.line_hits(spark, sf_dir).select("line_no", F.concat_ws("\t", "query_id", "subject_id", *cells).alias("value"))
    store = Store(spark, shared_folder(spark))
    broken = rows.where("line_no = 1").select(F.substring_index("value", "\t", 4).alias("value"))
    store.put(_written(spark, rows.select("value").unionByName(broken)), "hits", 1, "blastoutput")
    bad = store.table("rejects").groupBy(F.lit("rejected").alias("entry_key"), F.col("reason").alias("text")).agg(F.count("*").alias("n"))
    return store.get("hits").existing.select("entry_key", "text", F.lit(None).cast("long").alias("n")).unionByName(bad)


_DOMAIN = ["'t' || conv_id || '_' || turn", "'-'", "turn", "role", "'-'", *["'1'"] * 17]


@query(f"""SELECT md5(concat_ws(' ', {', '.join(_DOMAIN)}, {_ONE_LINE})) AS line_md5, md5(concat_ws(chr(9), {', '.join(_DOMAIN)}, {_ONE_LINE})) AS text_md5 FROM conversations WHERE {_ONE_LINE} <> ''""")
def domain_table(spark, sf_dir):
    """Turns as lines of a domain table under comments, whose last column holds blanks."""
    ones = [F.lit("1")] * 17
    rows = _turns(spark, sf_dir).where("text <> ''").select(F.concat_ws(" ", F.concat(F.lit("t"), "conv_id", F.lit("_"), "turn"), F.lit("-"), "turn", "role", F.lit("-"), *ones, "text").alias("value"))
    comments = spark.range(2).select(F.lit("# target name  accession").alias("value"))
    return _entries(spark, rows.unionByName(comments), "hmmeroutput").select(F.md5("entry_key").alias("line_md5"), F.md5("text").alias("text_md5"))


@query(f"""WITH {fx.FILES_SQL} SELECT 'fullfile' AS format, '/store/' || path AS entry_key, 'base/' || path || chr(9) || path || chr(9) || '/store/' || path AS text FROM files
UNION ALL SELECT 'priam', '/store/' || path, '/store/' || path || chr(9) || path FROM files""")
def listing_files(spark, sf_dir):
    """A file listing as lines, read and rendered by both formats that take it."""
    value = F.concat_ws("\t", F.concat(F.lit("base/"), "path"), "hash", "version", F.lit("/store"), F.lit("base"), "path")
    lines = fx.page_files(spark, sf_dir).select(value.alias("value"))
    both = [_entries(spark, lines, f).select(F.lit(f).alias("format"), "entry_key", "text") for f in ("fullfile", "priam")]
    return both[0].unionByName(both[1])


@query(f"""WITH {fx.RELEASES_SQL}, gone AS (SELECT entry_key FROM r1 WHERE entry_key NOT IN (SELECT entry_key FROM r2))
SELECT 'deleted' AS kind, entry_key AS key, NULL AS value FROM gone UNION ALL SELECT 'metadata', 'TABLE_NAME', 'documents' UNION ALL SELECT 'metadata', 'INC_ENTRIES', CAST((SELECT count(*) FROM r2) AS VARCHAR)
UNION ALL SELECT 'metadata', 'FULL_ENTRIES', CAST((SELECT count(*) FROM r2) AS VARCHAR) UNION ALL SELECT 'metadata', 'TYPE', 'LINE' UNION ALL SELECT 'metadata', 'TAXON', 'x'""")
def deleted_and_metadata_files(spark, sf_dir):
    """The deleted keys of a get as a list, with blanks and repeats, and its metadata as key and value lines, read again."""
    store = _store(spark, sf_dir, 1, 2)
    got = store.get("documents", start=1, addendum="x")
    listed = got.deleted.select(F.explode(F.array("entry_key", F.concat(F.lit(" "), "entry_key"), F.lit(""))).alias("text"))
    deleted = files.read_deleted(spark, _written(spark, sinks.key_value_lines(listed)))
    folder = shared_folder(spark)
    files.write_metadata(got.metadata, folder)
    rows = deleted.select(F.lit("deleted").alias("kind"), F.col("entry_key").alias("key"), F.lit(None).cast("string").alias("value"))
    return rows.unionByName(files.read_metadata(spark, folder).select(F.lit("metadata").alias("kind"), "key", "value"))


@query("""WITH d AS (SELECT doc_id % 16 AS n, '>' || doc_id AS head, replace(replace(replace(text, '>', ''), chr(10), ''), chr(13), '') AS body FROM documents)
SELECT n || '.fna' AS file, CAST(sum(length(trim(body, ' '))) AS BIGINT) AS base_pairs, count(*) AS contigs, NULL AS lines FROM d GROUP BY n
UNION ALL SELECT 'all', NULL, NULL, CAST(2 * count(*) AS BIGINT) FROM d""")
def sequence_scan(spark, sf_dir):
    """Sequence files found by their ending in a tree with others, measured, and joined into one folder."""
    body = F.translate("text", ">\n\r", "")
    docs = fx.table(spark, sf_dir, "documents").select((F.col("doc_id") % 16).alias("n"), F.concat_ws("\n", F.concat(F.lit(">"), "doc_id"), body).alias("record"))
    parts = docs.groupBy("n").agg(F.encode(F.array_join(F.collect_list("record"), "\n"), "UTF-8").alias("content"))
    named = [parts.select(F.concat(F.lit(f), "n", F.lit(e)).alias("path"), "content") for f, e in (("s/", ".fna"), ("s/other/", ".txt"))]
    folder, target = shared_folder(spark), shared_folder(spark)
    files.write_files(named[0].unionByName(named[1]), folder).count()
    found = counts.base_pairs(files.read_sequence_lines(spark, folder)).where("file IS NOT NULL")
    files.concatenate_sequences(spark, folder, target)
    every = spark.read.text(target).agg(F.count("*").alias("lines"))
    each = found.select(text.base_name(F.col("file")).alias("file"), "base_pairs", "contigs", F.lit(None).cast("long").alias("lines"))
    return each.unionByName(every.select(F.lit("all").alias("file"), F.lit(None).cast("long").alias("base_pairs"), F.lit(None).cast("long").alias("contigs"), "lines"))


@query(r"""WITH l AS (SELECT conv_id, turn, CASE WHEN regexp_full_match(text, 'conversation \d+') THEN '-' ELSE replace(text, chr(13), '') END AS text FROM conversations)
SELECT conv_id, md5('conversation ' || conv_id || chr(10) || string_agg(text, chr(10) ORDER BY turn)) AS record_md5 FROM l GROUP BY conv_id""")
def pattern_records(spark, sf_dir):
    """Conversations as records that a line of a pattern begins and another ends, cut out of files in splits."""
    body = F.when(F.col("text").rlike(r"\A(conversation \d+)\z"), "-").otherwise(F.translate("text", "\r", ""))
    lines = _gathered(fx.table(spark, sf_dir, "conversations"), body)
    value = F.concat(F.lit("skipped? no: the last record's end\nconversation "), "conv_id", F.lit("\n"), F.array_join("lines", "\n"), F.lit("\nend of it"))
    found = records.read_records_by_pattern(spark, _written(spark, lines.select(value.alias("value"))), r"conversation \d+", "end of it")
    number = F.regexp_extract("record", r"\Aconversation (\d+)", 1).cast("long")
    return found.select(number.alias("conv_id"), F.md5("record").alias("record_md5"))


@query("""SELECT '>' || doc_id AS entry_key, md5(replace(replace(replace(replace(text, '>', ''), chr(13), ''), chr(10), ''), ' ', '')) AS seq_md5, 2 AS n_versions FROM documents WHERE doc_id % 10 <> 3""")
def streamed_release(spark, sf_dir):
    """Two releases of documents dropped as FASTA files into a folder, put by the stream, and the second got."""
    folder, checkpoint = shared_folder(spark), shared_folder(spark)
    body = F.regexp_replace(F.translate("text", ">\r", ""), r"[\x00-\x20]", "")
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit(">"), "doc_id", F.lit("\n"), body).alias("value"))
    for version, rows in ((1, docs), (2, docs.where("doc_id % 10 <> 3"))):
        rows.select("value").write.text(f"{folder}/version={version}")
        parts = sum(size > 0 for _, size in Files(spark).parts(f"{folder}/version={version}"))
        spark.range(1).select(F.lit("closed").alias("content"), F.lit(f"version={version}/{parts}.done").alias("path")).transform(
            lambda m: files.write_files(m.select("path", F.encode("content", "UTF-8").alias("content")), folder)).count()
    store = Store(spark, shared_folder(spark))
    ingest(store, folder, "dropped", "fasta", checkpoint).awaitTermination()
    got = store.get("dropped", start=1).existing
    return got.select("entry_key", F.md5(F.element_at("fields", F.lit("SEQ"))).alias("seq_md5"), F.lit(len(store.versions("dropped"))).cast("long").alias("n_versions"))


@query("""WITH p AS (SELECT page_id, html, CASE WHEN page_id % 5 = 0 THEN html || '<!-- 2 -->' ELSE html END AS later, page_id % 7 = 3 AS gone FROM pages)
SELECT 'listed' AS kind, page_id, CAST(octet_length(encode(CASE WHEN gone THEN html ELSE later END)) AS BIGINT) AS size, CASE WHEN NOT gone AND page_id % 5 = 0 THEN 2 ELSE 1 END AS version, gone AS is_deleted FROM p
UNION ALL SELECT 'asked', page_id, CAST(octet_length(encode(later)) AS BIGINT), CASE WHEN page_id % 5 = 0 THEN 2 ELSE 1 END, false FROM p WHERE page_id = (SELECT min(page_id) FROM p WHERE NOT gone)""")
def raw_files(spark, sf_dir):
    """Pages as files put unparsed in two versions, some changed and some gone in the second, listed, and one asked for by its path."""
    pages = fx.table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("p/"), F.col("page_id"), F.lit(".html")).alias("path"), "html")
    later = pages.where("page_id % 7 <> 3").withColumn("html", F.when(F.col("page_id") % 5 == 0, F.concat("html", F.lit("<!-- 2 -->"))).otherwise(F.col("html")))
    store = Store(spark, shared_folder(spark))
    for version, rows in ((1, pages), (2, later)):
        folder = shared_folder(spark)
        files.write_files(rows.select("path", F.encode("html", "UTF-8").alias("content")), folder).count()
        store.put_raw(folder, "tree/pages", version)
    first = later.agg(F.min("page_id").alias("n")).first().n
    parts = {"listed": store.files("tree/pages"), "asked": store.get_file(f"tree/pages/p/{first}.html")}
    number = F.regexp_extract("below", r"(\d+)\.html$", 1).cast("long").alias("page_id")
    each = [rows.select(F.lit(kind).alias("kind"), number, "size", "version", "is_deleted") for kind, rows in parts.items()]
    return each[0].unionByName(each[1])


@query(f"""WITH {fx.RELEASES_SQL} SELECT entry_key, {_LINE} || '|checked' AS text FROM r2 c WHERE source LIKE '%1'""")
def store_post_hook(spark, sf_dir):
    """A format of the caller's own with a step after each get."""
    checked = lambda rows: rows.where(F.col("text").rlike(r"1(\|[^|]*)?$")).withColumn("text", F.concat("text", F.lit("|checked")))
    line = lambda f, a: F.concat_ws("|", *[F.element_at(f, F.lit(c)) for c in ("ID", "source", "lang")])
    own = formats.Format("own", "\n", lambda r: F.create_map(F.lit("ID"), r), {"LINE": line}, {"LINE": ("text",)}, default_type="LINE", post=checked)
    store = Store(spark, shared_folder(spark))
    fields = F.map_concat("fields", F.create_map(F.lit("ID"), F.concat(F.lit(">"), "entry_key")))
    store.put(fx.release(spark, sf_dir, 2).select("entry_key", fields.alias("fields")), "documents", 1, own)
    return store.get("documents").existing.where(F.element_at("fields", F.lit("source")).endswith("1")).select("entry_key", "text")


@query(f"""WITH {fx.FILES_SQL} SELECT path, regexp_extract(path, '(\\.[^./]*)$', 1) AS suffix, regexp_replace(path, '/?[^/]*$', '') AS parent, regexp_extract(path, '([^/]*)$', 1) AS name FROM files""")
def path_parts(spark, sf_dir):
    """Suffix, folder and name of each path."""
    path = F.col("path")
    return fx.page_files(spark, sf_dir).select("path", text.path_suffix(path).alias("suffix"), text.path_parent(path).alias("parent"), text.base_name(path).alias("name"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
