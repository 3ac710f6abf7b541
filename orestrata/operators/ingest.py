"""Raw copy of source tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orestrata.sources.overlap import PARALLELISM, overlap
from orestrata.sources.readers import Source

LOAD_REPORT = "TableName string, Status string, Rows bigint, Error string"


def ingest(
    spark: SparkSession,
    source: Source,
    table: str,
    columns: Iterable[str] | None = None,
    casts: Mapping[str, str] | None = None,
) -> DataFrame:
    """All rows of a source table with the schema the source has.

    ``columns`` narrows the copy, ``casts`` replaces types that do not travel.
    """
    df = source(spark, table)
    if columns is not None:
        df = df.select(*columns)
    for column, target in (casts or {}).items():
        df = df.withColumn(column, F.col(column).cast(target))
    return df


def load_isolated(
    spark: SparkSession,
    loads: Mapping[str, Callable[[], DataFrame]],
    parallelism: int = PARALLELISM,
) -> DataFrame:
    """Run each table's load on its own; a failing one does not stop the others.

    A load writes its table and returns it as stored. The result has one row
    per table: name, status, rows and error.
    """

    def attempt(table: str) -> tuple[str, str, int | None, str | None]:
        try:
            return table, "loaded", loads[table]().count(), None
        except Exception as error:  # whatever the source raises is reported
            return table, "failed", None, f"{type(error).__name__}: {error}"

    outcomes = overlap({table: partial(attempt, table) for table in loads}, parallelism)
    return spark.createDataFrame(list(outcomes.values()), LOAD_REPORT)


def row_counts(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(TableName, RowCount) per table, in one job."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("RowCount")).select(
            F.lit(name).alias("TableName"), "RowCount"
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts
