"""Tolerant casts used when loading raw files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_to_bool(c: Column) -> Column:
    """Text flag to BOOLEAN; unparseable text gives NULL instead of failing.

    Accepts Spark's boolean spellings (Y/N, T/F, yes/no, true/false, 1/0,
    any case, surrounding blanks trimmed). Blank or other text -> NULL, which
    the loader treats as a bad value when the source was not NULL.
    """
    return c.try_cast("boolean")


def range_checked_int(c: Column, digits: int = 3) -> Column:
    """Integer with at most ``digits`` digits (NUMBER(3) = -999..999), else NULL."""
    limit = 10 ** digits - 1
    v = c.try_cast("bigint")
    return F.when(v.between(-limit, limit), v.cast("int"))
