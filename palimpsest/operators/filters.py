"""Predicates on entries, keys and scopes."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import task_key


def parse_filter(text: str | Mapping[str, str] | None) -> dict[str, str]:
    """``FIELD=REGEX[,FIELD=REGEX...]`` or a mapping; a part without ``=`` continues the one before."""
    if not text:
        return {}
    if not isinstance(text, str):
        return dict(text)
    found: dict[str, str] = {}
    last = None
    for part in text.split(","):
        field, eq, pattern = part.partition("=")
        if eq:
            found[last := field.strip()] = pattern
        elif last:
            found[last] += "," + part
    return found


def whole_match(col: Column, pattern: str) -> Column:
    """Whether the whole value matches, in any case, with dots matching line ends too."""
    return col.rlike(rf"(?is)\A(?:{pattern})\z")


def matches(patterns: Mapping[str, str], fields: Column | None = None) -> Column:
    """All patterns match; a missing field fails. Fields are columns, or keys of the map ``fields``."""
    value = lambda f: F.col(f) if fields is None else F.element_at(fields, F.lit(f))
    tests = [F.coalesce(whole_match(value(f), p), F.lit(False)) for f, p in patterns.items()]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def filter_counts(entries: DataFrame, patterns: Mapping[str, str], fields: Column | None = None) -> DataFrame:
    """One row: entries that match, and entries with all fields that do not (missing fields count nowhere)."""
    value = lambda f: F.col(f) if fields is None else F.element_at(fields, F.lit(f))
    whole = reduce(lambda a, b: a & b, [value(f).isNotNull() for f in patterns], F.lit(True))
    hit = matches(patterns, fields)
    return entries.agg(F.count_if(hit).alias("entries"), F.count_if(whole & ~hit).alias("non_matching"))


def in_scope(rows: DataFrame, run_id: str | int | None, task_id: int | None = None) -> DataFrame:
    """Rows of a run, and of a task of it if one is given, by equality."""
    if run_id is not None:
        rows = rows.where(F.col("run_id") == F.lit(str(run_id)))
    return rows if task_id is None else rows.where(F.col("task_id") == task_key(task_id))


def key_prefix(rows: DataFrame, prefix: str, key: str = "entry_key") -> DataFrame:
    return rows.where(F.col(key).startswith(prefix))
