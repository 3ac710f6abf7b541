"""Key expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CASE_INSENSITIVE = "ci"
BINARY = "binary"


def comparable(value: Column, collation: str = CASE_INSENSITIVE) -> Column:
    """Raw text as it compares in the warehouse: letter case and trailing blanks do not count.

    An explicit key rather than a collated column, because joins on it can
    still be broadcast hash joins.
    """
    if collation == BINARY:
        return value
    if collation == CASE_INSENSITIVE:
        return F.upper(F.rtrim(value))
    raise ValueError(f"collation must be {CASE_INSENSITIVE!r} or {BINARY!r}, not {collation!r}")


def date_key(day: Column) -> Column:
    """yyyymmdd as an integer; NULL for NULL. Arithmetic, no string work."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).cast("int")


def last_characters(value: Column, count: int) -> Column:
    return F.right(value, F.lit(count))
