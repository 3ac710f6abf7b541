"""The whole build, and what must hold between its tables."""

import os
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orestrata import CatalogLayers, ConstraintViolation, FrameSource, PathLayers, build_warehouse
from orestrata.fixed_values import DIMENSIONS, FACT, GOLD, SILVER, TABLES
from orestrata.plans.profile import LISTS
from orestrata.plans.silver import SAMPLED
from orestrata.plans.warehouse import ORDER_DATES, REJECTS, LoadFailed, build_gold, build_silver
from orestrata_checks.contracts import BOUND

AS_OF = datetime(2002, 1, 1)
VIOLATIONS = {
    "CK_SalesOrderHeader_DueDate": 15,
    "CK_SalesOrderHeader_ShipDate": 16,
    "CK_SalesOrderDetail_OrderQty": 19,
    "CK_SalesOrderDetail_UnitPrice": 13,
    "PK_SalesOrderDetail": 24,
    "FIT_CreditCard_ExpYear": 2,
}


@pytest.fixture(scope="module")
def built(spark, bronze, tmp_path_factory):
    layers = PathLayers(spark, str(tmp_path_factory.mktemp("warehouse")))
    report = build_warehouse(spark, bronze.source, layers, "quarantine", AS_OF, contracts=BOUND)
    return layers, report


def test_reports(built):
    _, report = built
    loads = rows(report.loads)
    assert len(loads) == 14 and all(row[1] == "loaded" for row in loads)
    assert {name: n for name, _, n, _ in loads} == dict(rows(report.bronze_rows))
    assert report.profile.count() == 23
    assert list(report.findings) == list(LISTS) and all(df.count() for df in report.findings.values())
    assert {row[0]: row[1] for row in rows(report.integrity)}.keys() == {
        "ProductsWithoutSubcategory",
        "CustomersWithoutTerritory",
        "OrdersWithoutCustomer",
        "OrderDetailsWithoutProduct",
        "OrdersWithoutTerritory",
        "CustomersWithoutPerson",
    }
    assert {table: df.count() for table, df in report.samples.items()} == dict.fromkeys(SAMPLED, 10)
    assert {row[1]: row[2] for row in rows(report.violations) if row[2]} == VIOLATIONS
    counts = {row[0]: row[1:] for row in rows(report.silver_rows)}
    assert len(counts) == 14
    assert {name for name, row in counts.items() if not row[2]} == {
        "Product",
        "SalesOrderHeader",
        "SalesOrderDetail",
        "CreditCard",
    }
    assert {row[0]: row[2:4] for row in rows(report.calendar)} == dict.fromkeys(ORDER_DATES, (0, 0))
    assert dict(rows(report.gold_rows)) == {
        "Bronze Sales Details": 6000,
        "Silver Sales Details": 5944,
        "Gold FactSales Rows": 5716,
    }


def test_silver_is_bronze_less_rejects_and_copies(built):
    layers, report = built
    counts = {row[0]: row[1:] for row in rows(report.silver_rows)}
    copies = {"Product": 2}
    for table in TABLES:
        rejected = layers.read(SILVER, f"{table}{REJECTS}").count()
        before, after, _ = counts[table]
        assert after + rejected == before - copies.get(table, 0), table


def test_fact_and_losses_make_up_the_lines(built):
    layers, report = built
    silver_lines = layers.read(SILVER, "SalesOrderDetail")
    fact = layers.read(GOLD, FACT)
    lost = silver_lines.join(
        fact, F.col("SalesOrderDetailID") == F.col("SalesDetailKey"), "left_anti"
    ).count()
    assert fact.count() + lost == silver_lines.count()
    assert sum(n for _, n in rows(report.join_loss)) >= lost > 0
    assert fact.select("SalesDetailKey").distinct().count() == fact.count()


def test_surrogate_keys_are_dense_and_ordered(built):
    layers, _ = built
    for name, key, surrogate in (
        ("DimProduct", "ProductID", "SK_Product"),
        ("DimCustomer", "CustomerID", "SK_Customer"),
        ("DimGeography", "AddressID", "SK_Geography"),
        ("DimShipMethod", "ShipMethodID", "SK_ShipMethod"),
        ("DimCreditCard", "CreditCardID", "SK_CreditCard"),
    ):
        pairs = rows(layers.read(GOLD, name).select(key, surrogate).orderBy(key))
        assert [number for _, number in pairs] == list(range(1, len(pairs) + 1)), name


def test_fact_keys_are_found_in_dimensions(built):
    layers, _ = built
    fact = layers.read(GOLD, FACT)
    assert len(fact.columns) == 18
    for column, name, key in (
        ("SK_Product", "DimProduct", "SK_Product"),
        ("SK_Customer", "DimCustomer", "SK_Customer"),
        ("ShipGeographyKey", "DimGeography", "SK_Geography"),
        ("SK_ShipMethod", "DimShipMethod", "SK_ShipMethod"),
        ("SK_CreditCard", "DimCreditCard", "SK_CreditCard"),
        ("OrderDateKey", "DimDate", "DateKey"),
        ("DueDateKey", "DimDate", "DateKey"),
        ("ShipDateKey", "DimDate", "DateKey"),
    ):
        used = fact.select(F.col(column).alias("used")).where("used IS NOT NULL")
        known = layers.read(GOLD, name).select(F.col(key).alias("used"))
        assert used.join(known, "used", "left_anti").isEmpty(), column


def test_cards_stay_masked(built):
    layers, _ = built
    cards = layers.read(GOLD, "DimCreditCard")
    assert cards.where(~F.col("CardNumberMasked").rlike(r"^XXXX-XXXX-XXXX-\d{4}$")).isEmpty()
    assert rows(cards.select("ExpMonth", "ExpYear").distinct()) == [("**", "****")]


def test_second_build_gives_the_same_tables(spark, bronze, built):
    layers, _ = built
    names = [*DIMENSIONS, FACT]
    before = {name: sorted(map(str, rows(layers.read(GOLD, name)))) for name in names}
    spark.catalog.clearCache()
    build_warehouse(spark, bronze.source, layers, "quarantine", AS_OF, contracts=BOUND)
    for name in names:
        assert sorted(map(str, rows(layers.read(GOLD, name)))) == before[name], name


def test_fail_writes_no_silver_table(spark, bronze, tmp_path):
    layers = PathLayers(spark, str(tmp_path))
    with pytest.raises(ConstraintViolation, match="SalesOrder"):
        build_silver(bronze, layers, "fail", BOUND)
    assert not os.path.exists(tmp_path / SILVER)


def test_missing_source_table_stops_the_build(spark, bronze, tmp_path):
    frames = {table: bronze[table] for table in TABLES if table != "Store"}
    layers = PathLayers(spark, str(tmp_path))
    with pytest.raises(LoadFailed, match="Store"):
        build_warehouse(spark, FrameSource(frames), layers, "quarantine")
    # the other tables are there all the same
    assert layers.read("bronze", "Person").count() > 0


def test_fact_by_year(spark, built, tmp_path):
    layers, _ = built
    silver = {table: layers.read(SILVER, table) for table in TABLES}
    gold = build_gold(silver, PathLayers(spark, str(tmp_path)), AS_OF, fact_by_year=True)
    year = gold[FACT].where("OrderYear = 1997")
    assert "PartitionFilters: [isnotnull(OrderYear" in year._jdf.queryExecution().toString()
    expected = layers.read(GOLD, FACT).where("OrderDateKey BETWEEN 19970101 AND 19971231")
    assert sorted(rows(year.drop("OrderYear"))) == sorted(rows(expected))


def test_catalog_build_can_be_queried(spark, bronze, tmp_path):
    layers = CatalogLayers(spark, str(tmp_path), prefix="shop_")
    build_warehouse(
        spark,
        bronze.source,
        layers,
        "quarantine",
        calendar=("1995-01-01", "2001-12-31"),
        contracts=BOUND,
    )
    assert spark.table("shop_gold.DimDate").count() == 2557
    revenue = spark.sql(
        "SELECT p.CategoryName, sum(f.LineTotal) AS Revenue FROM shop_gold.FactSales f"
        " JOIN shop_gold.DimProduct p ON f.SK_Product = p.SK_Product GROUP BY ALL"
    )
    assert revenue.count() > 1
    dates = spark.table("shop_gold.DimProduct").agg(F.max("StartDate"), F.max("EndDate")).first()
    assert dates[0].year >= 2024 and dates[1] is None


def test_warn_stores_all_rows_and_lists_the_offending(spark, bronze, tmp_path):
    layers = PathLayers(spark, str(tmp_path))
    silver, violations = build_silver(bronze, layers, "warn", BOUND)
    assert silver["SalesOrderHeader"].count() == 1500
    assert {row[1]: row[2] for row in rows(violations) if row[2]} == VIOLATIONS
    assert layers.read(SILVER, f"SalesOrderHeader{REJECTS}").count() == 31
