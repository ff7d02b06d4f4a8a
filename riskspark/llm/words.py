"""Words of a text with JVM functions only: lower-cased in A-Z, cut at ASCII that is neither letter nor digit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The same in DuckDB, for a text expression in place of {}.
SQL_WORDS = (
    "regexp_extract_all(translate(coalesce({}, ''), '" + _UPPER + "', '" + _LOWER + "'), "
    + "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)


def words(text: Column) -> Column:
    """Array of words; empty for null. Only A-Z change case, so that other letters are compared as they are."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lower, APART), "")


def bytes_of(df: DataFrame) -> int:
    """Size of a stored table in its files, as the planner sees it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
