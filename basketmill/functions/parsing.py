"""Tolerant parsing: a value that does not parse becomes null instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def blank_to_null(column: Column) -> Column:
    """Empty or all-space text is a missing value; other text is kept as it is."""
    return F.when(F.trim(column) != "", column)


def parse_time(column: Column) -> Column:
    return column.try_cast("timestamp_ntz")


def parse_integer(column: Column) -> Column:
    return F.trim(column).try_cast("bigint")


def parse_number(column: Column) -> Column:
    return F.trim(column).try_cast("double")


def parse_date(column: Column) -> Column:
    """ISO dates only: a timestamp or free text gives null."""
    return F.when(F.length(column) == 10, F.try_to_date(column, "yyyy-MM-dd"))


def time_text(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
