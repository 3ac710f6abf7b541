"""The declared column types of the silver layer.

Parquet tables know neither lengths nor unsigned ranges, so a declared type
is a Spark type plus the test whether a value fits and the way it is stored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class StoredType:
    label: str
    spark: T.DataType
    max_length: int | None = None
    padded: bool = False
    bounds: tuple[int, int] | None = None

    def fits(self, value: Column, source: T.DataType) -> Column | None:
        """Whether ``value`` (of type ``source``) can be stored; None if it always can."""
        if self.max_length is not None:
            return F.char_length(value) <= self.max_length
        tests = []
        if source != self.spark:
            tests.append(value.isNull() | value.try_cast(self.spark).isNotNull())
        if self.bounds is not None:
            tests.append(value.between(*self.bounds))
        if not tests:
            return None
        passed = tests[0]
        for test in tests[1:]:
            passed = passed & test
        return passed

    def store(self, value: Column) -> Column:
        """Never truncates: an overlong text is kept and left to ``fits``."""
        if not self.padded:
            return value.try_cast(self.spark)
        text = value.cast(self.spark)
        return F.when(
            F.char_length(text) < self.max_length, F.rpad(text, self.max_length, " ")
        ).otherwise(text)


INT = StoredType("int", T.IntegerType())
BIGINT = StoredType("bigint", T.LongType())
SMALLINT = StoredType("smallint", T.ShortType())
TINYINT = StoredType("tinyint", T.ShortType(), bounds=(0, 255))  # unsigned
BIT = StoredType("bit", T.BooleanType())
MONEY = StoredType("money", T.DecimalType(19, 4))
DATE = StoredType("date", T.DateType())
DOCUMENT = StoredType("document", T.StringType())


def decimal(precision: int, scale: int) -> StoredType:
    return StoredType(f"decimal({precision},{scale})", T.DecimalType(precision, scale))


def text(length: int) -> StoredType:
    return StoredType(f"text({length})", T.StringType(), max_length=length)


def fixed_text(length: int) -> StoredType:
    return StoredType(f"fixed_text({length})", T.StringType(), max_length=length, padded=True)
