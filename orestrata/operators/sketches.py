"""Distinct counts kept as mergeable sketches, file by file.

An approximate distinct count can be kept: a sketch of a few kilobytes per file and column, merged for any set of
files. Profiling a table again then reads only the files that are new since.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of a sketch's size: 2^12 registers, a relative error of about 1.6 %.
LOG_SIZE = 12
_FILE = "File"


def file_sketches(df: DataFrame, values: Mapping[str, Column], log_size: int = LOG_SIZE) -> DataFrame:
    """(File, Name, Rows, Sketch): per file of a stored table a sketch of each of the named values."""
    by_file = df.select(F.input_file_name().alias(_FILE), *[value.alias(name) for name, value in values.items()])
    sketched = by_file.groupBy(_FILE).agg(
        F.count(F.lit(1)).alias("Rows"), *[F.hll_sketch_agg(name, log_size).alias(name) for name in values]
    )
    rows = [F.struct(F.lit(name).alias("Name"), "Rows", F.col(name).alias("Sketch")) for name in values]
    return sketched.select(_FILE, F.inline(F.array(*rows)))


def sketched_counts(sketches: DataFrame) -> DataFrame:
    """(Name, Rows, DistinctEstimate) of all files together."""
    return sketches.groupBy("Name").agg(
        F.sum("Rows").alias("Rows"), F.hll_sketch_estimate(F.hll_union_agg("Sketch")).alias("DistinctEstimate")
    )


class SketchStore:
    """The sketches of one table, in a folder of their own next to it."""

    def __init__(self, spark: SparkSession, folder: str, values: Mapping[str, Column], log_size: int = LOG_SIZE):
        self.spark = spark
        self.folder = folder
        self.values = values
        self.log_size = log_size

    def _kept(self) -> DataFrame:
        schema = f"{_FILE} string, Name string, Rows bigint, Sketch binary"
        try:
            return self.spark.read.schema(schema).parquet(self.folder)
        except AnalysisException:
            return self.spark.createDataFrame([], schema)

    def update(self, df: DataFrame) -> list[str]:
        """Sketch the files of ``df`` which have none yet, and only those; returns them."""
        known = {row[_FILE] for row in self._kept().select(_FILE).distinct().collect()}
        new = sorted(set(df.inputFiles()) - known)
        if new:
            own = self.spark.read.schema(df.schema).parquet(*new)
            file_sketches(own, self.values, self.log_size).coalesce(1).write.mode("append").parquet(self.folder)
        return new

    def counts(self, df: DataFrame) -> DataFrame:
        """The estimates for the files which ``df`` has now."""
        self.update(df)
        present = self.spark.createDataFrame([(each,) for each in df.inputFiles()], f"{_FILE} string")
        return sketched_counts(self._kept().join(present, _FILE, "left_semi"))
