"""Records are parsed once, and trimmed as SQL trims."""

import duckdb
import pytest

from palimpsest.functions.text import trim_control
from palimpsest.sources.formats import FORMATS


@pytest.mark.parametrize("name,body", [("fasta", "SEQ"), ("glimmer", "DAT")])
def test_a_record_is_parsed_once(spark, tmp_path, name, body):
    (tmp_path / "a.fa").write_text("; none\n>a one \n AC \nGT\n>c\n \n>b\n>b\nT\n")
    judged = FORMATS[name].judged(FORMATS[name].records(spark, str(tmp_path))).where("reason IS NULL").select("entry_key", "fields")
    assert judged._jdf.queryExecution().optimizedPlan().toString().count("map(ID, concat(>") == 1
    text = {"SEQ": ("ACGT", ""), "DAT": (" AC \nGT", " ")}[body]
    got = {r.entry_key: r.fields[body] for r in FORMATS[name].read(spark, str(tmp_path)).collect()}
    assert got == {">a one": text[0], ">c": text[1], ">b": ""}


def test_trimming_takes_what_sql_takes(spark):
    values = [" \x00a b\t\r\n", "a \u0085", "  a  ", "\x1f\x20", "", "a\n\n", "é  ", "x" + " " * 9 + "y", None]
    got = [r.v for r in spark.createDataFrame([(v,) for v in values], "v string").select(trim_control("v").alias("v")).collect()]
    sql = r"SELECT regexp_replace(regexp_replace(v, '^[\x00-\x20]+', ''), '[\x00-\x20]+$', '') FROM (SELECT unnest(?) AS v)"
    assert got == [r[0] for r in duckdb.execute(sql, [values]).fetchall()]
