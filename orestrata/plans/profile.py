"""The checks run on bronze before anything is cleansed.

Each check is a function of the bronze tables. Table labels and anomaly names
are fixed values.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.functions.keys import CASE_INSENSITIVE, comparable
from orestrata.operators.profiling import (
    DISTINCT,
    DUPLICATE,
    MATCHING,
    ORPHAN,
    TableCheck,
    combined_report,
    distinct_count,
    distinct_values,
    duplicate_keys,
    is_missing,
    orphan_check,
    predicate_check,
)

Bronze = Mapping[str, DataFrame]
Profile = Callable[[Bronze], DataFrame]

# name: (table, label of the table, anomaly, key)
DUPLICATES = {
    "dup_product": ("Product", "Product", "Duplicate ProductID", "ProductID"),
    "dup_customer": ("Customer", "Customer", "Duplicate CustomerID", "CustomerID"),
    "dup_sales_order": (
        "SalesOrderHeader",
        "SalesOrderHeader",
        "Duplicate SalesOrderID",
        "SalesOrderID",
    ),
}

# name: (table, label of the table, anomaly, predicate, example column)
PREDICATES: dict[str, tuple[str, str, str, Callable[[], Column], str | None]] = {
    "nonpositive_qty": (
        "SalesOrderDetail",
        "SalesOrderDetail",
        "Non-positive OrderQty",
        lambda: F.col("OrderQty") <= 0,
        "OrderQty",
    ),
    "negative_unit_price": (
        "SalesOrderDetail",
        "SalesOrderDetail",
        "Negative UnitPrice",
        lambda: F.col("UnitPrice") < 0,
        "UnitPrice",
    ),
    "bad_list_price": (
        "Product",
        "Product",
        "Negative or Null ListPrice",
        lambda: F.col("ListPrice").isNull() | (F.col("ListPrice") < 0),
        "ListPrice",
    ),
    "negative_standard_cost": (
        "Product",
        "Product",
        "Negative StandardCost",
        lambda: F.col("StandardCost") < 0,
        "StandardCost",
    ),
    "ship_before_order": (
        "SalesOrderHeader",
        "SalesOrderHeader",
        "ShipDate before OrderDate",
        lambda: F.col("ShipDate") < F.col("OrderDate"),
        None,
    ),
    "due_before_order": (
        "SalesOrderHeader",
        "SalesOrderHeader",
        "DueDate before OrderDate",
        lambda: F.col("DueDate") < F.col("OrderDate"),
        None,
    ),
    "missing_person_name": (
        "Person",
        "Person",
        "Missing FirstName or LastName",
        lambda: is_missing(["FirstName", "LastName"]),
        None,
    ),
    "missing_city_postal": (
        "Address",
        "[Address]",
        "Missing City or PostalCode",
        lambda: is_missing(["City", "PostalCode"]),
        None,
    ),
    "missing_color": (
        "Product",
        "Product",
        "Missing Color",
        lambda: is_missing(["Color"]),
        None,
    ),
}

# name: (table, label of the table, anomaly, column)
DISTINCT_COUNTS = {
    "distinct_color": ("Product", "Product", "Distinct raw Color values", "Color"),
    "distinct_country": (
        "CountryRegion",
        "CountryRegion",
        "Distinct raw Name values",
        "Name",
    ),
}

# name: (child, label, anomaly, reference, parent, key, nullable, collation)
ORPHANS = {
    "orphan_detail_product": (
        "SalesOrderDetail",
        "SalesOrderDetail",
        "Orphaned ProductID",
        "ProductID",
        "Product",
        "ProductID",
        False,
        None,
    ),
    "orphan_header_customer": (
        "SalesOrderHeader",
        "SalesOrderHeader",
        "Orphaned CustomerID",
        "CustomerID",
        "Customer",
        "CustomerID",
        False,
        None,
    ),
    "orphan_header_territory": (
        "SalesOrderHeader",
        "SalesOrderHeader",
        "Orphaned TerritoryID",
        "TerritoryID",
        "SalesTerritory",
        "TerritoryID",
        True,
        None,
    ),
    "orphan_product_subcategory": (
        "Product",
        "Product",
        "Orphaned ProductSubcategoryID",
        "ProductSubcategoryID",
        "ProductSubcategory",
        "ProductSubcategoryID",
        True,
        None,
    ),
    "orphan_subcategory_category": (
        "ProductSubcategory",
        "ProductSubcategory",
        "Orphaned ProductCategoryID",
        "ProductCategoryID",
        "ProductCategory",
        "ProductCategoryID",
        False,
        None,
    ),
    "orphan_address_state": (
        "Address",
        "[Address]",
        "Orphaned StateProvinceID",
        "StateProvinceID",
        "StateProvince",
        "StateProvinceID",
        False,
        None,
    ),
    "orphan_state_country": (
        "StateProvince",
        "StateProvince",
        "Orphaned CountryRegionCode",
        "CountryRegionCode",
        "CountryRegion",
        "CountryRegionCode",
        False,
        CASE_INSENSITIVE,
    ),
    "orphan_customer_person": (
        "Customer",
        "Customer",
        "Orphaned PersonID",
        "PersonID",
        "Person",
        "BusinessEntityID",
        True,
        None,
    ),
    "orphan_customer_store": (
        "Customer",
        "Customer",
        "Orphaned StoreID",
        "StoreID",
        "Store",
        "BusinessEntityID",
        True,
        None,
    ),
}


def _duplicates(bronze: Bronze, name: str) -> DataFrame:
    table, label, anomaly, key = DUPLICATES[name]
    return duplicate_keys(bronze[table], [key], label, anomaly)


def _predicate(bronze: Bronze, name: str) -> DataFrame:
    table, label, anomaly, predicate, example = PREDICATES[name]
    shown = None if example is None else F.col(example)
    return predicate_check(bronze[table], label, anomaly, predicate(), shown)


def _distinct(bronze: Bronze, name: str) -> DataFrame:
    table, label, anomaly, column = DISTINCT_COUNTS[name]
    return distinct_count(bronze[table], column, label, anomaly)


def _orphans(bronze: Bronze, name: str) -> DataFrame:
    child, label, anomaly, fk, parent, pk, nullable, collation = ORPHANS[name]
    return orphan_check(
        bronze[child],
        fk,
        bronze[parent],
        pk,
        label,
        anomaly,
        nullable=nullable,
        collation=collation,
    )


def missing_color_by_category(bronze: Bronze) -> DataFrame:
    """(Category, MissingColorCount) of products without a color, most first.

    Counted per subcategory before the category is looked up.
    """
    per_subcategory = (
        bronze["Product"]
        .where(is_missing(["Color"]))
        .groupBy("ProductSubcategoryID")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    subcategories = bronze["ProductSubcategory"].select("ProductSubcategoryID", "ProductCategoryID")
    categories = bronze["ProductCategory"].select("ProductCategoryID", "Name")
    return (
        per_subcategory.join(subcategories, "ProductSubcategoryID", "left")
        .join(categories, "ProductCategoryID", "left")
        .groupBy(comparable(F.col("Name")).alias("_category"))
        .agg(F.min("Name").alias("Category"), F.sum("_rows").alias("MissingColorCount"))
        .select("Category", "MissingColorCount")
        .orderBy(F.col("MissingColorCount").desc(), F.col("Category").asc_nulls_first())
    )


def products_null_color(bronze: Bronze) -> DataFrame:
    """Products whose color is NULL; blank ones are not listed."""
    return (
        bronze["Product"]
        .where(F.col("Color").isNull())
        .select("ProductID", "Name", "ProductNumber", "ProductSubcategoryID")
    )


def products_no_subcategory(bronze: Bronze) -> DataFrame:
    return (
        bronze["Product"]
        .where(F.col("ProductSubcategoryID").isNull())
        .agg(F.count(F.lit(1)).alias("ProductsWithoutSubcategory"))
    )


def colored_no_subcategory(bronze: Bronze) -> DataFrame:
    return (
        bronze["Product"]
        .where(F.col("ProductSubcategoryID").isNull() & F.col("Color").isNotNull())
        .select("ProductID", "Name", "Color")
    )


def color_values(bronze: Bronze, collation: str = CASE_INSENSITIVE) -> DataFrame:
    return distinct_values(bronze["Product"], "Color", collation)


def country_values(bronze: Bronze, collation: str = CASE_INSENSITIVE) -> DataFrame:
    return distinct_values(bronze["CountryRegion"], "Name", collation)


PROFILES: dict[str, Profile] = {
    **{name: partial(_duplicates, name=name) for name in DUPLICATES},
    **{name: partial(_predicate, name=name) for name in PREDICATES},
    **{name: partial(_distinct, name=name) for name in DISTINCT_COUNTS},
    **{name: partial(_orphans, name=name) for name in ORPHANS},
    "missing_color_by_category": missing_color_by_category,
    "products_null_color": products_null_color,
    "products_no_subcategory": products_no_subcategory,
    "colored_no_subcategory": colored_no_subcategory,
    "color_values": color_values,
    "country_values": country_values,
}


# What is listed after the counts, for people to look at.
LISTS = (
    "missing_color_by_category",
    "products_null_color",
    "products_no_subcategory",
    "colored_no_subcategory",
    "color_values",
    "country_values",
)


def table_checks() -> list[TableCheck]:
    """All counting checks, to be answered together."""
    checks = [
        TableCheck(
            MATCHING, table, label, anomaly, predicate=predicate(), example=None if example is None else F.col(example)
        )
        for table, label, anomaly, predicate, example in PREDICATES.values()
    ]
    checks += [
        TableCheck(DUPLICATE, table, label, anomaly, F.col(key)) for table, label, anomaly, key in DUPLICATES.values()
    ]
    for child, label, anomaly, fk, parent, pk, nullable, collation in ORPHANS.values():
        reference, key = (F.col(fk), F.col(pk)) if collation is None else (
            comparable(F.col(fk), collation),
            comparable(F.col(pk), collation),
        )
        checks.append(TableCheck(ORPHAN, child, label, anomaly, reference, (parent, key), nullable))
    checks += [
        TableCheck(DISTINCT, table, label, anomaly, comparable(F.col(column)))
        for table, label, anomaly, column in DISTINCT_COUNTS.values()
    ]
    return checks


def profile_report(bronze: Bronze) -> DataFrame:
    """All counting checks as one relation: one scan of each table, one exchange of keys.

    A check without an example, or without a distinct count, leaves that column NULL.
    """
    return combined_report(bronze, table_checks())
