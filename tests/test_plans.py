"""What the physical plans must and must not contain."""

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from orestrata import surrogate_key
from orestrata.operators.lookup import optional_lookup
from orestrata.operators.profiling import orphan_count, predicate_check
from orestrata.plans.contracts import SALES_ORDER_HEADER
from orestrata.operators.conform import conform
from orestrata.sources.shared import settle
from orestrata_checks.catalog import queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", queries())
def test_no_python_no_cross_join(spark, name):
    if name in ("load_isolated", "full_refresh"):
        pytest.skip("stores tables and returns their counts")
    text = plan(queries()[name](spark, SMALL))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "NestedLoopJoin"):
        assert operator not in text
    # Limits only where a report asks for the first rows.
    if not name.startswith(("sample_", "bq_top")):
        assert "Limit" not in text and "TakeOrdered" not in text


def test_single_partition_only_over_range_counts(spark):
    df = settle(spark.range(1000).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("v")))
    text = plan(surrogate_key(df, "k", "SK"))
    assert text.count("SinglePartition") == 1
    single = text[text.index("SinglePartition") :]
    assert re.search(r"ReadSchema: struct<k:int>", single)


def test_predicates_reach_the_scan(spark):
    df = settle(spark.range(10).select(F.col("id").alias("v"), F.lit("x").alias("other")))
    text = plan(predicate_check(df, "T", "A", F.col("v") < 0, F.col("v")))
    assert "LessThan(v,0)" in text and "ReadSchema: struct<v:bigint>" in text


def test_orphans_are_reduced_before_an_anti_join(spark, shuffled):
    child = settle(spark.range(100).withColumnRenamed("id", "fk"))
    parent = settle(spark.range(50).withColumnRenamed("id", "pk"))
    text = plan(orphan_count(child, "fk", parent, "pk"))
    assert "LeftAnti" in text
    # child and parent once each, and the final count; none between grouping and join
    assert text.count("Exchange hashpartitioning") == 2


def test_unique_table_passes_without_exchange(spark, bronze):
    stored = settle(bronze["SalesOrderHeader"])
    good = conform(stored, SALES_ORDER_HEADER, "quarantine").good
    assert "Exchange" not in plan(good) and "Join" not in plan(good)


def test_stored_dimensions_are_broadcast_and_lines_shuffled_once(spark):
    text = plan(queries()["bq_distinct_orders"](spark, SMALL))
    initial = text.split("== Initial Plan ==")[-1]
    assert len(re.findall(r"BroadcastHashJoin [^\n]*Inner", initial)) == 4
    assert initial.count("SortMergeJoin") == 1
    # the lines with a number that repeats are few and settled, and so are set apart by broadcast
    assert len(re.findall(r"BroadcastHashJoin [^\n]*Left(Anti|Outer)", initial)) == 2


def test_fact_reads_only_what_a_question_needs(spark):
    text = plan(queries()["bq_total_revenue"](spark, SMALL))
    schemas = re.findall(r"orders\.parquet.*?ReadSchema: struct<(.*?)>", text)
    assert schemas and all("o_totalprice" not in schema for schema in schemas)


def test_hot_key_is_split(spark, shuffled):
    facts = settle(
        spark.range(60_000)
        .select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("fk"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        .repartition(8)
    )
    keys = settle(spark.range(60_000).select(F.col("id").alias("pk"), (F.col("id") * 2).alias("sk")))
    joined = facts.join(keys, F.col("fk") == F.col("pk")).agg(F.max("payload"), F.count("sk"))
    assert joined.collect()[0][1] == 60_000
    assert "skew=true" in plan(joined)


def test_null_references_are_spread(spark, shuffled):
    child = settle(
        spark.range(40_000).select(
            F.col("id").cast("int").alias("id"),
            F.when(F.col("id") % 4 == 0, F.col("id").cast("int")).alias("fk"),
        )
    )
    parent = settle(spark.range(40_000).select(F.col("id").cast("int").alias("pk"), F.lit(1).alias("x")))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = optional_lookup(child, "fk", parent, "pk", spread_by="id")
        sizes = [
            row["count"] for row in joined.groupBy(F.spark_partition_id()).count().collect()
        ]
        matched = joined.where("x IS NOT NULL").count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 40_000 and matched == 10_000
    assert max(sizes) < 2 * 40_000 / 8
