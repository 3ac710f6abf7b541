"""Removing folders, on whatever file system Spark reaches them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    located = spark._jvm.org.apache.hadoop.fs.Path(path)
    return located.getFileSystem(spark._jsc.hadoopConfiguration()), located


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds, if it is there."""
    system, located = _located(spark, path)
    system.delete(located, True)


def remove_if_empty(spark: SparkSession, path: str) -> None:
    system, located = _located(spark, path)
    if system.exists(located) and not system.listStatus(located):
        system.delete(located, True)
