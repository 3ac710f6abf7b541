"""Distinct sketches per file: their error, merging, and what is read again."""

import pytest
from pyspark.sql import functions as F

from orestrata.functions.keys import comparable
from orestrata.operators.sketches import SketchStore, file_sketches, sketched_counts


@pytest.fixture
def values():
    return {"k": F.col("k"), "color": comparable(F.col("color"))}


def table(spark, first, last, folder, mode="append"):
    df = spark.range(first, last, numPartitions=3).select(
        (F.col("id") % 70_000).alias("k"), F.concat(F.lit("Red"), (F.col("id") % 40).cast("string"), F.lit(" ")).alias("color")
    )
    df.write.mode(mode).parquet(folder)
    return spark.read.parquet(folder)


def test_estimates_are_close_to_the_exact_counts(spark, values, tmp_path):
    df = table(spark, 0, 200_000, str(tmp_path / "t"))
    found = {r.Name: (r.Rows, r.DistinctEstimate) for r in sketched_counts(file_sketches(df, values)).collect()}
    exact = df.agg(*[F.count_distinct(value).alias(name) for name, value in values.items()]).first()
    assert found["k"][0] == found["color"][0] == 200_000
    for name in values:
        assert abs(found[name][1] - exact[name]) <= 0.05 * exact[name]


def test_only_new_files_are_sketched(spark, values, tmp_path):
    folder = str(tmp_path / "t")
    store = SketchStore(spark, str(tmp_path / "sketches"), values)
    df = table(spark, 0, 30_000, folder)
    assert len(store.update(df)) == 3 and store.update(df) == []
    grown = table(spark, 30_000, 60_000, folder)
    new = store.update(grown)
    assert len(new) == 3 and not set(new) & set(df.inputFiles())
    counts = {r.Name: r for r in store.counts(grown).collect()}
    assert counts["k"].Rows == 60_000 and abs(counts["k"].DistinctEstimate - 60_000) <= 3_000
    # of a table laid out anew, only what is there now counts
    small = table(spark, 0, 1_000, folder, mode="overwrite")
    assert {r.Name: (r.Rows, r.DistinctEstimate) for r in store.counts(small).collect()}["color"] == (1_000, 40)


def test_empty_table(spark, values, tmp_path):
    spark.range(0).selectExpr("id AS k", "'x' AS color").write.parquet(str(tmp_path / "t"))
    store = SketchStore(spark, str(tmp_path / "sketches"), values)
    assert store.counts(spark.read.schema("k bigint, color string").parquet(str(tmp_path / "t"))).count() <= 2
