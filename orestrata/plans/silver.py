"""Silver layer: cleansed tables under contract, and their validation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestrata.fixed_values import TABLES
from orestrata.operators.conform import Contract, conform
from orestrata.operators.expectations import FAIL, Enforced
from orestrata.operators.profiling import orphan_count
from orestrata.operators.reconcile import reconcile
from orestrata.plans.contracts import CONTRACTS
from orestrata.sources.overlap import PARALLELISM, overlap


def conform_tables(
    bronze: Mapping[str, DataFrame],
    tables: Iterable[str] = TABLES,
    policy: str = FAIL,
    contracts: Mapping[str, Contract] = CONTRACTS,
    parallelism: int = PARALLELISM,
) -> dict[str, Enforced]:
    """Conform several tables; none depends on another, so their jobs overlap."""

    def conformed(table: str) -> Enforced:
        return conform(bronze[table], contracts[table], policy)

    return overlap({table: partial(conformed, table) for table in tables}, parallelism)


def silver_tables(
    bronze: Mapping[str, DataFrame],
    tables: Iterable[str] = TABLES,
    policy: str = FAIL,
    contracts: Mapping[str, Contract] = CONTRACTS,
) -> dict[str, DataFrame]:
    conformed = conform_tables(bronze, tables, policy, contracts)
    return {table: result.good for table, result in conformed.items()}


def silver_row_counts(
    bronze: Mapping[str, DataFrame], silver: Mapping[str, DataFrame]
) -> DataFrame:
    """(TableName, BronzeRows, SilverRows, RowsMatch) of all tables."""
    return reconcile(
        {
            "bronze": {table: bronze[table] for table in TABLES},
            "silver": {table: silver[table] for table in TABLES},
        }
    )


def _null_count(df: DataFrame, column: str, alias: str) -> DataFrame:
    return df.where(F.col(column).isNull()).agg(F.count(F.lit(1)).alias(alias))


def products_without_subcategory(silver: Mapping[str, DataFrame]) -> DataFrame:
    return _null_count(silver["Product"], "ProductSubcategoryID", "ProductsWithoutSubcategory")


def customers_without_territory(silver: Mapping[str, DataFrame]) -> DataFrame:
    return _null_count(silver["Customer"], "TerritoryID", "CustomersWithoutTerritory")


def orders_without_customer(silver: Mapping[str, DataFrame]) -> DataFrame:
    return orphan_count(
        silver["SalesOrderHeader"],
        "CustomerID",
        silver["Customer"],
        "CustomerID",
        alias="OrdersWithoutCustomer",
    )


def details_without_product(silver: Mapping[str, DataFrame]) -> DataFrame:
    return orphan_count(
        silver["SalesOrderDetail"],
        "ProductID",
        silver["Product"],
        "ProductID",
        alias="OrderDetailsWithoutProduct",
    )


def orders_without_territory(silver: Mapping[str, DataFrame]) -> DataFrame:
    return orphan_count(
        silver["SalesOrderHeader"],
        "TerritoryID",
        silver["SalesTerritory"],
        "TerritoryID",
        nullable=True,
        alias="OrdersWithoutTerritory",
    )


def customers_without_person(silver: Mapping[str, DataFrame]) -> DataFrame:
    return orphan_count(
        silver["Customer"],
        "PersonID",
        silver["Person"],
        "BusinessEntityID",
        nullable=True,
        alias="CustomersWithoutPerson",
    )


# name: (check, tables it reads)
VALIDATIONS = {
    "products_without_subcategory": (products_without_subcategory, ("Product",)),
    "customers_without_territory": (customers_without_territory, ("Customer",)),
    "orders_without_customer": (orders_without_customer, ("SalesOrderHeader", "Customer")),
    "details_without_product": (details_without_product, ("SalesOrderDetail", "Product")),
    "orders_without_territory": (
        orders_without_territory,
        ("SalesOrderHeader", "SalesTerritory"),
    ),
    "customers_without_person": (customers_without_person, ("Customer", "Person")),
}



def integrity_report(silver: Mapping[str, DataFrame]) -> DataFrame:
    """(CheckName, AffectedRows) of all validations of references, none of which should find anything."""
    found = [check(silver) for check, _ in VALIDATIONS.values()]
    return reduce(
        DataFrame.unionByName,
        [df.select(F.lit(df.columns[0]).alias("CheckName"), F.col(df.columns[0]).alias("AffectedRows")) for df in found],
    )


# Tables shown as samples after a load.
SAMPLED = ("Product", "Customer", "SalesOrderHeader", "SalesOrderDetail")
