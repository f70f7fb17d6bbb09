"""File formats as column expressions: how records are cut, parsed, judged and rendered.

Parsing gives (entry_key, fields map<string,string>) and a flag for records that must be rejected.
Formats whose line order matters keep it in field names that begin with a six-digit ordinal.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import squeeze_sequence, trim_control
from ..operators.hits import HIT_COLUMNS
from .records import read_records, read_records_by_pattern


@dataclass(frozen=True)
class Format:
    """``parse`` maps a record column to a map of fields (null rejects the record); ``key`` maps the
    fields to the entry key; ``render`` has an expression of (fields, addendum) per output type."""

    name: str
    separator: str
    parse: Callable[[Column], Column]
    render: dict[str, Callable[[Column, Column], Column]]
    required: dict[str, tuple[str, ...]] = field(default_factory=dict)
    key: Callable[[Column], Column] = lambda fields: trim_control(F.element_at(fields, F.lit("ID")))
    default_type: str = "FULL"
    incremental: bool = True
    #: What begins each record, where the separator ends with it: lines before a file's first one are skipped.
    start: str | None = None
    #: Patterns of the whole lines that begin a record, and that end one (or None): where given, records are cut by them, not by the separator.
    bounds: tuple[str, str | None] | None = None
    #: Applied to the rendered entries of every get.
    post: Callable[[DataFrame], DataFrame] | None = None

    def records(self, spark: SparkSession, path: str | list[str]) -> DataFrame:
        """(file, block, record) of the files at or below ``path``."""
        if self.bounds is not None:
            return read_records_by_pattern(spark, path, *self.bounds).select("file", "block", "record")
        return read_records(spark, path, self.separator, self.start)

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        return self.entries(self.records(spark, path))

    def judged(self, records: DataFrame) -> DataFrame:
        """(file, block, record, entry_key, fields, reason) of records that are not blank.

        A record that does not parse, or has no key, has a reason and keeps its text; of the others the
        text is not kept. file and block are null where ``records`` has none.
        """
        place = [F.col(c) if c in records.columns else F.lit(None).cast(kind).alias(c) for c, kind in (("file", "string"), ("block", "long"))]
        # exploded, of one: so that what is asked of the fields is asked after parsing, not by parsing again
        parsed = records.where(F.col("record").rlike(r"\S")).select(*place, "record", F.explode(F.array(self.parse(F.col("record")))).alias("fields"))
        keyed = parsed.withColumn("entry_key", self.key(F.col("fields")))
        reason = F.when(F.col("fields").isNull(), "not a record of the format").when(F.col("entry_key").isNull(), "no key")
        return keyed.select("file", "block", F.when(reason.isNotNull(), F.col("record")).alias("record"), "entry_key", "fields", reason.alias("reason"))

    def chosen(self, judged: DataFrame) -> DataFrame:
        """(entry_key, fields) of good records; of several with one key the first by content is kept."""
        dealt = judged.select("entry_key", "fields").repartition("entry_key")  # so that fields travel once, and their JSON not at all
        return dealt.groupBy("entry_key").agg(F.min_by("fields", F.to_json("fields")).alias("fields"))

    def entries(self, records: DataFrame) -> DataFrame:
        """(entry_key, fields) of records; see :meth:`judged` and :meth:`chosen`."""
        return self.chosen(self.judged(records).where("reason IS NULL"))

    def rejected(self, records: DataFrame) -> DataFrame:
        """(file, block, record, reason) of the records that :meth:`entries` leaves out."""
        return self.judged(records).where("reason IS NOT NULL").select("file", "block", "record", "reason")

    def rendered(self, entries: DataFrame, kind: str | None = None, addendum: str = "") -> DataFrame:
        """``entries`` (with fields) with the column text."""
        text = entries.withColumn("text", self.render[kind or self.default_type](F.col("fields"), F.lit(addendum)))
        return self.post(text) if self.post else text


def _get(fields: Column, name: str) -> Column:
    return F.element_at(fields, F.lit(name))


def _lines(record: Column) -> Column:
    """Lines, of either line end; a last line end, whole or cut by the separator, is none."""
    return F.split(F.regexp_replace(record, r"(\r?\n|\r)\z", ""), r"\r?\n")


def _headed(body: str, join: str, clean: bool) -> Callable[[Column], Column]:
    """Header line to ID; the other lines, trimmed if they are to be, joined to ``body``."""

    def fields(lines: Column) -> Column:
        rest = F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1)))
        text = F.array_join(F.transform(rest, trim_control) if clean else rest, join)
        return F.create_map(F.lit("ID"), F.concat(F.lit(">"), trim_control(lines[0])), F.lit(body), text)

    # lines are bound, as an expression that is used thrice is worked out thrice
    return lambda record: F.get(F.transform(F.array(_lines(F.regexp_replace(record, r"\A\s*>", ""))), fields), F.lit(0))


def coded_fields(lines: Column, code: Callable[[Column], Column], body: Callable[[Column], Column]) -> Column:
    """Code to text; lines of one code joined by newlines in order; codes in order of first use in ``#order``."""
    codes = F.array_distinct(F.transform(lines, code))
    text = lambda c: F.array_join(F.transform(F.filter(lines, lambda x: code(x) == c), body), "\n")
    return F.map_concat(F.map_from_arrays(codes, F.transform(codes, text)), F.create_map(F.lit("#order"), F.array_join(codes, ",")))


def _dat(record: Column) -> Column:
    lines = F.filter(_lines(record), lambda x: (x != "//") & (x != ""))
    code = lambda x: F.when(F.trim(F.substring(x, 1, 2)) == "", "SE").otherwise(F.substring(x, 1, 2))
    body = lambda x: F.substr(x, F.lit(6))
    return F.when(F.size(lines) > 0, F.when(~F.exists(lines, lambda x: F.length(x) < 5), coded_fields(lines, code, body)))


def _dat_text(fields: Column, addendum: Column) -> Column:
    codes = F.filter(F.split(_get(fields, "#order"), ","), lambda c: c != "ID")
    line = lambda c, x: F.concat(F.when(c == "SE", "  ").otherwise(c), F.lit("   "), x)
    block = lambda c: F.array_join(F.transform(F.split(F.element_at(fields, c), "\n"), lambda x: line(c, x)), "\n")
    return F.array_join(F.concat(F.array(F.concat(F.lit("ID   "), _get(fields, "ID"))), F.transform(codes, block), F.array(F.lit("//"))), "\n")


def ordinal_lines(lines: Column, name: Callable[[Column], Column]) -> Column:
    """Each line under its six-digit ordinal and a tag."""
    keys = F.transform(lines, lambda x, i: F.concat_ws("-", F.lpad(i.cast("string"), 6, "0"), name(x)))
    return F.map_from_arrays(keys, lines)


def lines_in_order(fields: Column) -> Column:
    """The lines kept by :func:`ordinal_lines`, joined again."""
    kept = F.filter(F.array_sort(F.map_entries(fields)), lambda e: e["key"].rlike(r"^\d{6}-"))
    return F.translate(F.array_join(F.transform(kept, lambda e: e["value"]), "\n"), "\x00", "")


def _profile(record: Column) -> Column:
    lines = _lines(F.regexp_replace(record, r"\A(?!\s*HMMER)", "HMMER"))
    tag = lambda x: F.when(F.trim(F.substring(x, 1, 4)).isin(*PROFILE_TAGS), F.trim(F.substring(x, 1, 4))).otherwise("DAT")
    named = F.filter(lines, lambda x: F.substring(x, 1, 4) == "NAME")
    return F.map_concat(ordinal_lines(lines, tag), F.create_map(F.lit("ID"), F.trim(F.substr(F.get(named, F.lit(0)), F.lit(5)))))


def _alignment(record: Column) -> Column:
    lines = F.filter(_lines(record), lambda x: (x != "//") & (x != ""))
    named = F.filter(lines, lambda x: x.startswith("#=GF ID"))
    tag = lambda x: F.trim(F.substring(x, 1, 10))
    return F.map_concat(ordinal_lines(lines, tag), F.create_map(F.lit("ID"), F.trim(F.substr(F.get(named, F.lit(0)), F.lit(8)))))


def _columns(names: tuple[str, ...], separator: str, least: int, rest: str | None = None) -> Callable[[Column], Column]:
    def parse(record: Column) -> Column:
        parts = F.split(record, separator, len(names) + 1 if rest is None else len(names))
        cells = F.map_from_arrays(F.slice(F.array(*map(F.lit, names)), 1, F.least(F.size(parts), F.lit(len(names)))), F.slice(parts, 1, len(names)))
        return F.when(F.size(parts) >= least, F.map_concat(cells, F.create_map(F.lit("ID"), record)))

    return parse


def _tabbed(names: tuple[str, ...]) -> Callable[[Column, Column], Column]:
    return lambda fields, addendum: F.concat_ws("\t", *[F.coalesce(_get(fields, n), F.lit("")) for n in names])


def _listing(record: Column) -> Column:
    """Tab-separated path, hash, version, target, base, relative path to ID, HASH, PATH, SUFFIX."""
    parts = F.split(record, "\t")
    return F.when(F.size(parts) >= 6, F.create_map(
        F.lit("ID"), F.concat_ws("/", parts[3], parts[5]), F.lit("HASH"), parts[1], F.lit("PATH"), parts[0], F.lit("SUFFIX"), parts[5]))


# Tags of profile files, and the columns of the domain table (its second score and bias renamed).
PROFILE_TAGS = ("NAME", "ACC", "DESC", "LENG", "ALPH", "RF", "CS", "MAP", "DATE", "COM", "NSEQ", "EFFN", "CKSUM", "GA", "TC", "NC", "STAT", "HMM", "COMP")
DOMAIN_COLUMNS = (
    "target_name", "target_accession", "tlen", "query_name", "accession", "qlen", "e_value", "score", "bias", "dnum", "of", "c_evalue",
    "i_evalue", "dom_score", "dom_bias", "from_hmm", "to_hmm", "from_ali", "to_ali", "from_env", "to_env", "acc", "description",
)


def _named_sequence(fields: Column, addendum: Column) -> Column:
    header = F.when(addendum == "", F.concat(F.lit(">"), _get(fields, "ID"))).otherwise(F.concat(F.lit(">"), _get(fields, "ID"), F.lit(" "), addendum))
    return F.concat_ws("\n", header, squeeze_sequence(_get(fields, "SE")))


FORMATS: dict[str, Format] = {
    f.name: f
    for f in (
        Format("fasta", "\n>", _headed("SEQ", "", True), {"FASTA": lambda f, a: F.concat_ws("\n", _get(f, "ID"), squeeze_sequence(_get(f, "SEQ")))},
               {"FASTA": ("ID", "SEQ")}, default_type="FASTA", start=">"),
        Format("uniprot", "\n//", _dat, {"FASTA": _named_sequence, "DAT": _dat_text}, {"FASTA": ("ID", "SE"), "DAT": ("ID", "AC", "DE", "SE")},
               key=lambda f: F.trim(F.substring(_get(f, "ID"), 1, 12)), default_type="FASTA"),
        Format("glimmer", "\n>", _headed("DAT", "\n", False), {"GLIMMER": lambda f, a: F.concat_ws("\n", _get(f, "ID"), F.coalesce(_get(f, "DAT"), F.lit("")))},
               {"GLIMMER": ("ID", "DAT")}, default_type="GLIMMER", start=">"),
        Format("hmm", "\nHMMER", _profile, {"hmm": lambda f, a: lines_in_order(f)}, default_type="hmm", incremental=False, start="HMMER"),
        Format("pfam", "\n//", _alignment, {"STOCKHOLM": lambda f, a: F.concat(lines_in_order(f), F.lit("\n//"))}, default_type="STOCKHOLM", incremental=False),
        Format("blastoutput", "\n", _columns(HIT_COLUMNS, "\t", 5), {"blastoutput": _tabbed(HIT_COLUMNS)}, {"blastoutput": HIT_COLUMNS}, default_type="blastoutput"),
        Format("hmmeroutput", "\n", lambda r: F.when(~r.startswith("#"), _columns(DOMAIN_COLUMNS, " +", 22, "description")(r)),
               {"hmmeroutput": _tabbed(DOMAIN_COLUMNS)}, {"hmmeroutput": DOMAIN_COLUMNS[:22]}, default_type="hmmeroutput"),
        Format("fullfile", "\n", _listing, {"files": lambda f, a: F.concat_ws("\t", _get(f, "PATH"), _get(f, "SUFFIX"), _get(f, "ID"))}, default_type="files", incremental=False),
        Format("priam", "\n", _listing, {"files": lambda f, a: F.concat_ws("\t", _get(f, "ID"), _get(f, "SUFFIX"))}, default_type="files", incremental=False),
    )
}
