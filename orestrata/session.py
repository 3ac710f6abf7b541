"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution splits the partitions of hot keys in joins, also where
# that costs another exchange behind the join, and picks broadcast joins and
# partition counts by the sizes it has seen.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Rows go to the files of a few parts (kept and rejected, years) side by side, instead of being sorted by part.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}

# Partitions before adaptive execution joins small ones: up to this many, a task writes them without holding rows back.
LEAST_PARTITIONS = 200
# What it joins them up to, and what a task reads of a file, unless the session says so itself: sorted keys take two bytes
# in a shuffle or a file and fifty and more in memory, where so many of them are sorted and counted without spilling.
SIZES = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
    "spark.sql.files.maxPartitionBytes": "32m",
}
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def adaptive(spark: SparkSession) -> SparkSession:
    """Make sure adaptive execution is on; leaves sizes and resources to the cluster."""
    for key, value in ADAPTIVE.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """``adaptive``, and partitions of shuffles whose size does not grow with the tables; a session's own settings stay."""
    adaptive(spark)
    for key, value in SIZES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    if spark.conf.get(_INITIAL, None) is None and int(spark.conf.get("spark.sql.shuffle.partitions")) < LEAST_PARTITIONS:
        spark.conf.set(_INITIAL, str(LEAST_PARTITIONS))
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session on this machine, for tests and measurements."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("orestrata")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.codegen.cache.maxEntries", "2000")  # many queries, one session
        .config("spark.sql.ui.explainMode", "simple")
    )
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
