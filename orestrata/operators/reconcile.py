"""Comparison of layers and deterministic samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestrata.fixed_values import SAMPLE_ROWS


def reconcile(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """One row per table: its row count in each layer, and whether all agree.

    ``layers`` maps a layer's name to its tables. The counts of all layers are
    taken in one job and turned into columns by an aggregation over the
    handful of count rows.
    """
    counts = reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("_rows")).select(
                F.lit(table).alias("TableName"), F.lit(layer).alias("_layer"), "_rows"
            )
            for layer, tables in layers.items()
            for table, df in tables.items()
        ],
    )
    names = [f"{layer.capitalize()}Rows" for layer in layers]
    wide = counts.groupBy("TableName").agg(
        *[
            F.max(F.when(F.col("_layer") == layer, F.col("_rows"))).alias(name)
            for layer, name in zip(layers, names)
        ]
    )
    same = reduce(
        lambda left, right: left & right,
        [F.col(name).eqNullSafe(F.col(names[0])) for name in names[1:]],
        F.lit(True),
    )
    return wide.withColumn("RowsMatch", same)


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """(Layer, Row_Count) of one table as it passes through the layers."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("Row_Count")).select(
                F.lit(label).alias("Layer"), "Row_Count"
            )
            for label, df in layers.items()
        ],
    )


def sample(df: DataFrame, key: str | Sequence[str], rows: int = SAMPLE_ROWS) -> DataFrame:
    """The first rows by key: a look at the table which is the same each time."""
    return df.orderBy(*([key] if isinstance(key, str) else key)).limit(rows)
