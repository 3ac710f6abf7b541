"""Cleansing rules: each takes a column and returns the cleansed column.

All are built-in expressions, so that a table's rules collapse into one
projection inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = Callable[[Column], Column]


def carry(value: Column) -> Column:
    return value


def trim(value: Column) -> Column:
    """Strip spaces (only spaces) on both ends."""
    return F.trim(value)


def upper_trim(value: Column) -> Column:
    return F.upper(F.trim(value))


def blank_to_default(default: str, inner: Rule = trim) -> Rule:
    """NULL or blank becomes ``default``; anything else goes through ``inner``."""

    def rule(value: Column) -> Column:
        return F.coalesce(F.nullif(inner(value), F.lit("")), F.lit(default))

    return rule


def negative_to_zero(value: Column) -> Column:
    """A NULL stays NULL: whether that is allowed is for NOT NULL to say."""
    return F.when(value < 0, F.lit(0)).otherwise(value)


def null_or_negative_to_zero(value: Column) -> Column:
    return F.greatest(F.coalesce(value, F.lit(0)), F.lit(0))


def to_date(value: Column) -> Column:
    return value.cast("date")
