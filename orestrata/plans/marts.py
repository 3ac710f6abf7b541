"""The business questions, asked of the fact and its dimensions.

Revenue is the sum of the line totals. Order-level amounts repeat on each
line of an order and are therefore not summed here. Questions by an attribute
of a dimension add up the lines per dimension key first, and look the
attribute up on those sums.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestrata.fixed_values import TOP_TERRITORIES

Dimensions = Mapping[str, DataFrame]

_REVENUE = "decimal(38,4)"


def _revenue_per_key(fact: DataFrame, key: str) -> DataFrame:
    return fact.groupBy(key).agg(F.sum("LineTotal").alias("_revenue"))


def _revenue(alias: str = "Revenue"):
    return F.sum("_revenue").cast(_REVENUE).alias(alias)


def total_revenue(fact: DataFrame) -> DataFrame:
    return fact.agg(F.sum("LineTotal").cast(_REVENUE).alias("TotalRevenue"))


def distinct_orders(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count_distinct("OrderKey").alias("DistinctOrders"))


def unique_customers(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count_distinct("SK_Customer").alias("UniqueCustomers"))


def average_order_value(fact: DataFrame) -> DataFrame:
    """Revenue per order: orders are reduced to their revenue, then averaged."""
    totals = _revenue_per_key(fact, "OrderKey").agg(
        F.sum("_revenue").cast(_REVENUE).alias("_total"), F.count(F.lit(1)).alias("_orders")
    )
    average = F.try_divide(F.col("_total").cast("double"), F.col("_orders").cast("double"))
    return totals.select(average.alias("AverageOrderValue"))


def top_territories(
    fact: DataFrame, dimensions: Dimensions, count: int = TOP_TERRITORIES
) -> DataFrame:
    """Territories the most revenue was shipped to. Addresses outside any form a NULL one."""
    territories = dimensions["DimGeography"].select(
        F.col("SK_Geography").alias("ShipGeographyKey"), "Territoryname"
    )
    return (
        _revenue_per_key(fact, "ShipGeographyKey")
        .join(territories, "ShipGeographyKey")
        .groupBy("Territoryname")
        .agg(_revenue())
        .orderBy(F.col("Revenue").desc(), F.col("Territoryname").asc_nulls_first())
        .limit(count)
    )


def category_revenue(fact: DataFrame, dimensions: Dimensions, *levels: str) -> DataFrame:
    products = dimensions["DimProduct"].select("SK_Product", *levels)
    return (
        _revenue_per_key(fact, "SK_Product")
        .join(products, "SK_Product")
        .groupBy(*levels)
        .agg(_revenue())
        .orderBy(F.col("Revenue").desc(), *levels)
    )


def top_category(fact: DataFrame, dimensions: Dimensions) -> DataFrame:
    return category_revenue(fact, dimensions, "CategoryName").limit(1)


def category_subcategory(fact: DataFrame, dimensions: Dimensions) -> DataFrame:
    return category_revenue(fact, dimensions, "CategoryName", "SubcategoryName")
