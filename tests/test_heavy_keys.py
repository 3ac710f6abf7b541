"""Heavy keys are found by a sketch and dealt to many tasks by the library itself."""

from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orestrata.operators.lookup import heavy_keys, required_lookup
from orestrata.plans.gold import fact_sales, key_map, DIMENSION_KEYS
from orestrata.sources.shared import settle
from orestrata_checks.catalog import Bronze, silver
from conftest import SMALL


@pytest.fixture
def unadapted(spark, shuffled):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def heated(spark):
    """30 % of 60,000 rows refer to one key, 10 % to another, the rest to 6,000 keys."""
    n = F.col("id")
    key = F.when(n % 10 < 3, F.lit(7)).when(n % 10 == 3, F.lit(8)).otherwise(100 + n % 6000)
    return settle(spark.range(60_000).select(key.alias("fk"), n.alias("row")).repartition(8))


def test_heavy_keys_are_those_that_fill_half_a_partition(spark):
    df = heated(spark)
    assert sorted(heavy_keys(df, ["fk"], partitions=8)["fk"]) == [7, 8]
    assert sorted(heavy_keys(df, ["fk"], partitions=2)["fk"]) == [7]
    assert heavy_keys(df, ["fk", "row"], partitions=8)["row"] == []
    counts = Counter(r.fk for r in df.collect())
    found = heavy_keys(df, ["fk"], partitions=400)["fk"]
    assert set(found) == {key for key, count in counts.items() if count >= 60_000 / 800}
    assert heavy_keys(df.limit(0), ["fk"]) == {"fk": []}
    texts = df.select(F.when(F.col("fk") == 7, F.lit(None)).otherwise(F.col("fk").cast("string")).alias("t"))
    assert heavy_keys(texts, ["t"], partitions=8) == {"t": ["8"]}


def test_heavy_rows_are_dealt_to_many_tasks(spark, unadapted):
    df = heated(spark)
    parents = settle(spark.range(6_200).select(F.col("id").alias("pk"), (F.col("id") * 2).alias("sk")))
    joined = {
        name: required_lookup(df, "fk", parents, "pk", heavy)
        for name, heavy in (("plain", ()), ("heavy", heavy_keys(df, ["fk"])["fk"]))
    }
    sizes = {
        name: [r["count"] for r in each.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        for name, each in joined.items()
    }
    assert max(sizes["plain"]) > 2 * 60_000 / 8
    assert max(sizes["heavy"]) <= 2 * 60_000 / 8
    assert sum(sizes["heavy"]) == 60_000
    assert joined["heavy"].columns == joined["plain"].columns
    differing = joined["heavy"].exceptAll(joined["plain"])
    assert differing.isEmpty() and joined["heavy"].count() == joined["plain"].count()


def test_a_fact_with_heavy_orders_and_products_is_the_same(spark):
    tables = silver(spark, SMALL, ["SalesOrderHeader", "SalesOrderDetail", "Customer", "Product", "Address", "ShipMethod", "CreditCard"])
    tables = {name: settle(df) for name, df in tables.items()}
    lines = tables["SalesOrderDetail"]
    hot = F.crc32(F.col("SalesOrderDetailID").cast("string")) % 3 == 0
    tables["SalesOrderDetail"] = settle(
        lines.withColumns({"SalesOrderID": F.when(hot, 7).otherwise(F.col("SalesOrderID")), "ProductID": F.when(hot, 11).otherwise(F.col("ProductID"))})
    )
    maps = {name: settle(key_map(name, tables)) for name in DIMENSION_KEYS}
    heavy = heavy_keys(tables["SalesOrderDetail"], ["SalesOrderID", "ProductID"])
    assert heavy == {"SalesOrderID": [7], "ProductID": [11]}
    found = fact_sales(tables, maps, heavy=heavy)
    assert sorted(map(str, rows(found))) == sorted(map(str, rows(fact_sales(tables, maps))))
    assert Bronze(spark, SMALL)["SalesOrderDetail"].count() == 6000
