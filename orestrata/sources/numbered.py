"""Tables without a numeric key of their own get one as they are read."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from orestrata.operators.ranks import ranked
from orestrata.sources.readers import Source


@dataclass(frozen=True)
class Numbering:
    """A 64-bit column holding the rank of a row by some of its columns, which may be left out afterwards."""

    column: str
    key: tuple[str, ...]
    drop: tuple[str, ...] = ()


@dataclass(frozen=True)
class NumberedSource:
    """A source some of whose tables are numbered. Rows with equal keys share a number, so that a
    key which is none shows up in the check of the number.

    Numbering moves all rows of the table once; store the table before it is read again.
    """

    source: Source
    numberings: Mapping[str, Numbering] = field(default_factory=dict)

    def __call__(self, spark: SparkSession, table: str) -> DataFrame:
        df = self.source(spark, table)
        numbering = self.numberings.get(table)
        if numbering is None:
            return df
        return ranked(df, numbering.key, numbering.column).drop(*numbering.drop)
