"""Bronze layer: the source tables as they are."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from orestrata.fixed_values import BRONZE, DOCUMENT_COLUMNS, SOURCE_COLUMNS, TABLES
from orestrata.operators.ingest import ingest, load_isolated, row_counts
from orestrata.sources.layers import Layers
from orestrata.sources.readers import Source


def bronze_table(spark: SparkSession, source: Source, table: str) -> DataFrame:
    """A raw copy; documents travel as text, their content unchanged."""
    return ingest(
        spark,
        source,
        table,
        columns=SOURCE_COLUMNS.get(table),
        casts=dict.fromkeys(DOCUMENT_COLUMNS.get(table, ()), "string"),
    )


def load_bronze(
    spark: SparkSession, source: Source, layers: Layers, tables: Iterable[str] = TABLES
) -> DataFrame:
    """Replace the bronze tables, each on its own; returns the load report."""

    def load(table: str) -> DataFrame:
        return layers.write(bronze_table(spark, source, table), BRONZE, table)

    return load_isolated(spark, {table: lambda table=table: load(table) for table in tables})


def bronze_row_counts(spark: SparkSession, bronze: dict[str, DataFrame]) -> DataFrame:
    return row_counts(spark, {table: bronze[table] for table in TABLES})
