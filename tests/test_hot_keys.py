"""A build in which single keys, NULLs and copies hold a third of their tables.

No join may broadcast here. The result is compared with SQL on the same
stored raw tables.
"""

import duckdb
import pytest
from pyspark.sql import functions as F

from orestrata import PathLayers
from orestrata.fixed_values import BRONZE, TABLES
from orestrata.plans import marts
from orestrata.plans.gold import fact_join_loss, fact_sales
from orestrata.plans.profile import profile_report
from orestrata.plans.warehouse import REJECTS, build_gold, build_silver
from orestrata_checks.catalog import AS_OF, snake
from orestrata_checks.compare import differences
from orestrata_checks.contracts import BOUND
from orestrata_checks.oracle import oracle_sql, with_ctes


def third(key, hot, otherwise):
    return F.when(F.crc32(F.col(key).cast("string")) % 3 == 0, hot).otherwise(F.col(otherwise))


def heated(bronze):
    """The raw tables with hot orders, customers, products, NULLs, copies and conflicts."""
    tables = {table: bronze[table] for table in TABLES}
    lines = tables["SalesOrderDetail"]
    line = "SalesOrderDetailID"
    lines = lines.withColumn("SalesOrderID", third(line, 7, "SalesOrderID"))
    tables["SalesOrderDetail"] = lines.withColumn("ProductID", third(line, 11, "ProductID"))
    orders = tables["SalesOrderHeader"]
    for column, hot in (("CustomerID", 6), ("ShipToAddressID", 7), ("CreditCardID", None)):
        orders = orders.withColumn(column, third("SalesOrderID", F.lit(hot).cast("bigint"), column))
    tables["SalesOrderHeader"] = orders
    products = tables["Product"]
    times = F.explode(F.sequence(F.lit(1), F.lit(120)))
    copies = products.where("ProductID = 11").limit(1).withColumn("n", times)
    conflicts = products.where("ProductID = 12").limit(1).withColumn("n", times)
    conflicts = conflicts.withColumn("Name", F.concat("Name", F.col("n") % 2))
    tables["Product"] = products.unionByName(copies.drop("n")).unionByName(conflicts.drop("n"))
    cards = tables["CreditCard"]
    no_key = cards.where("CreditCardID = 13").limit(1).withColumn("n", times)
    no_key = no_key.withColumn("CreditCardID", F.lit(None).cast("bigint"))
    no_key = no_key.withColumn("CardType", F.concat("CardType", F.col("n") % 2))
    tables["CreditCard"] = cards.unionByName(no_key.drop("n"))
    return tables


def test_hot_build_equals_sql(spark, bronze, shuffled, tmp_path):
    layers = PathLayers(spark, str(tmp_path))
    database = duckdb.connect()
    raw = {}
    for table, df in heated(bronze).items():
        raw[table] = layers.write(df.repartition(8), BRONZE, table)
        files = layers.path(BRONZE, table) + "/*.parquet"
        database.execute(f"CREATE VIEW bronze_{snake(table)} AS SELECT * FROM '{files}'")
    silver, _ = build_silver(raw, layers, "quarantine", BOUND)
    gold = build_gold(silver, layers, AS_OF)
    sql = oracle_sql(bound=False)

    found = {snake(name): df for name, df in gold.items()}
    found |= {f"silver_{snake(table)}": df for table, df in silver.items()}
    found["profile_report"] = profile_report(raw)
    found["fact_join_loss"] = fact_join_loss(silver, gold)
    found["bq_top5_territories"] = marts.top_territories(gold["FactSales"], gold)
    found["bq_category_subcategory"] = marts.category_subcategory(gold["FactSales"], gold)
    problems = {name: differences(df, database, sql[name]) for name, df in found.items()}
    assert {name: each for name, each in problems.items() if each} == {}

    rejected = {}
    for table in ("Product", "CreditCard"):
        rejected[table] = layers.read("silver", f"{table}{REJECTS}").drop("UnfitValues")
        joined = rejected[table].withColumn("FailedConstraints", F.array_join("FailedConstraints", ","))
        rejects_sql = with_ctes(f"FROM rejects_{snake(table)}", bound=False)
        assert differences(joined, database, rejects_sql) == []
    assert rejected["Product"].count() >= 2 and silver["Product"].where("ProductID = 11").count() == 1
    assert rejected["CreditCard"].where("CreditCardID IS NULL").count() == 2

    measures = [F.max(column) for column in ("SalesChannel", "LineTotal", "UnitPrice", "SalesDetailKey")]
    fact = fact_sales(silver, gold).agg(F.count("SalesDetailKey"), *measures)
    fact.collect()
    assert "skew=true" in fact._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("width", [1000, 100_000])
def test_clustered_keys_keep_their_rank(spark, width):
    """Two thirds of the keys side by side, the rest far apart."""
    from orestrata import surrogate_key

    dense = spark.range(20_000).select((F.col("id") + 1_000_000).cast("int").alias("k"))
    sparse = spark.range(1, 10_001).select((F.col("id") * -200_000).cast("int").alias("k"))
    numbered = surrogate_key(dense.unionByName(sparse), "k", "SK", width)
    wrong = numbered.where(
        F.when(F.col("k") < 0, F.col("k") / -200_000 + F.col("SK") != 10_001).otherwise(
            F.col("SK") != F.col("k") - 1_000_000 + 10_001
        )
    )
    assert numbered.count() == 30_000 and wrong.isEmpty()
