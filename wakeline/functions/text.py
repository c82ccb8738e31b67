"""Lenient text handling: blanks become NULL and unreadable values never raise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline.schema import TIMESTAMP_PATTERN


def blank_to_null(column: Column) -> Column:
    return F.nullif(F.trim(column), F.lit(""))


def to_double(column: Column) -> Column:
    return column.try_cast("double")


def to_int(column: Column) -> Column:
    """Whole part of a number in text form ('31.0' is 31); NULL when it is not a number."""
    return column.try_cast("double").try_cast("int")


def to_instant(column: Column, pattern: str | None = TIMESTAMP_PATTERN) -> Column:
    """Timestamp from text; without a pattern every ISO-like form Spark knows is read."""
    if pattern is None:
        return F.try_to_timestamp(column)
    return F.try_to_timestamp(column, F.lit(pattern))


def strip_all(column: Column) -> Column:
    """Remove spaces, tabs and line ends on both sides."""
    return F.btrim(column, F.lit(" \t\n\r\x0b\x0c"))
