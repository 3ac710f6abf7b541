"""Gold layer: the star schema over silver.

Dimensions are meant to be stored before the fact is built: the fact looks up
the very keys they publish, and whether a dimension may be broadcast follows
from the size it has on disk.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.fixed_values import (
    BRONZE_LINES,
    CARD_DIGITS_SHOWN,
    CARD_MASK,
    CHANNEL_ONLINE,
    CHANNEL_RESELLER,
    CUSTOMER_IS_BOTH,
    CUSTOMER_IS_INDIVIDUAL,
    CUSTOMER_IS_STORE,
    EXPIRY_MONTH_MASK,
    EXPIRY_YEAR_MASK,
    GOLD_LINES,
    INDIVIDUAL_CUSTOMER,
    NOT_AVAILABLE,
    SILVER_LINES,
    UNKNOWN,
)
from orestrata.functions.keys import date_key, last_characters
from orestrata.operators.lookup import Heavy, optional_lookup, required_lookup
from orestrata.operators.reconcile import layer_counts
from orestrata.operators.surrogate import surrogate_key

Silver = Mapping[str, DataFrame]
Dimensions = Mapping[str, DataFrame]


def _validity(as_of: datetime | None) -> list[Column]:
    """Each build publishes the current state only: valid from now on, with no end."""
    since = F.localtimestamp() if as_of is None else F.lit(as_of)
    return [
        since.cast("timestamp_ntz").alias("StartDate"),
        F.lit(None).cast("timestamp_ntz").alias("EndDate"),
        F.lit(1).alias("IsCurrent"),
    ]


def dim_product(silver: Silver, as_of: datetime | None = None) -> DataFrame:
    """Products with their subcategory and category. The hierarchy is joined first."""
    categories = silver["ProductCategory"].select(
        "ProductCategoryID", F.col("Name").alias("_category")
    )
    hierarchy = optional_lookup(
        silver["ProductSubcategory"].select(
            "ProductSubcategoryID", "ProductCategoryID", F.col("Name").alias("_subcategory")
        ),
        "ProductCategoryID",
        categories,
        "ProductCategoryID",
        spread_by="ProductSubcategoryID",
    ).drop("ProductCategoryID")
    products = surrogate_key(silver["Product"], "ProductID", "SK_Product")
    return optional_lookup(
        products, "ProductSubcategoryID", hierarchy, "ProductSubcategoryID", spread_by="ProductID"
    ).select(
        "SK_Product",
        "ProductID",
        F.col("Name").alias("ProductName"),
        "ProductNumber",
        F.col("Color").alias("ProductColor"),
        "Size",
        "Weight",
        "ProductLine",
        "Class",
        "Style",
        "StandardCost",
        "ListPrice",
        F.coalesce("_subcategory", F.lit(NOT_AVAILABLE)).alias("SubcategoryName"),
        F.coalesce("_category", F.lit(NOT_AVAILABLE)).alias("CategoryName"),
        *_validity(as_of),
    )


def dim_customer(silver: Silver, as_of: datetime | None = None) -> DataFrame:
    """Customers, named after their person or else their store."""
    people = silver["Person"].select("BusinessEntityID", "FirstName", "LastName")
    stores = silver["Store"].select("BusinessEntityID", F.col("Name").alias("_store"))
    customers = surrogate_key(silver["Customer"], "CustomerID", "SK_Customer")
    customers = optional_lookup(
        customers, "PersonID", people, "BusinessEntityID", spread_by="CustomerID"
    )
    customers = optional_lookup(
        customers, "StoreID", stores, "BusinessEntityID", spread_by="CustomerID"
    )
    full_name = F.concat("FirstName", F.lit(" "), F.coalesce("LastName", F.lit("")))
    has_person, has_store = F.col("PersonID").isNotNull(), F.col("StoreID").isNotNull()
    return customers.select(
        "SK_Customer",
        "CustomerID",
        "PersonID",
        "StoreID",
        "TerritoryID",
        "AccountNumber",
        F.coalesce(full_name, "_store", F.lit(UNKNOWN)).alias("CustomerName"),
        F.coalesce("_store", F.lit(INDIVIDUAL_CUSTOMER)).alias("StoreName"),
        F.when(has_person & has_store, CUSTOMER_IS_BOTH)
        .when(has_person, CUSTOMER_IS_INDIVIDUAL)
        .when(has_store, CUSTOMER_IS_STORE)
        .otherwise(UNKNOWN)
        .alias("CustomerType"),
        *_validity(as_of),
    )


def dim_geography(silver: Silver) -> DataFrame:
    """Addresses with state, country and territory.

    States are resolved to their country and territory first, so that the
    addresses, by far the largest of the four, take part in one join only.
    """
    states = silver["StateProvince"].select(
        "StateProvinceID",
        "StateProvinceCode",
        F.col("Name").alias("_state"),
        F.col("CountryRegionCode").alias("_country_code"),
        F.col("TerritoryID").alias("_territory"),
    )
    countries = silver["CountryRegion"].select("CountryRegionCode", F.col("Name").alias("_country"))
    countries = countries.withColumn("_code", F.col("CountryRegionCode"))
    territories = silver["SalesTerritory"].select(
        F.col("TerritoryID").alias("_id"),
        "TerritoryID",
        F.col("Name").alias("Territoryname"),
        F.col("Group").alias("_group"),
    )
    places = optional_lookup(
        states, "_country_code", countries, "_code", spread_by="StateProvinceID"
    )
    places = optional_lookup(places, "_territory", territories, "_id", spread_by="StateProvinceID")
    places = places.withColumn("_state_id", F.col("StateProvinceID"))
    addresses = surrogate_key(silver["Address"], "AddressID", "SK_Geography")
    addresses = addresses.withColumnRenamed("StateProvinceID", "_reference")
    return optional_lookup(
        addresses, "_reference", places, "_state_id", spread_by="AddressID"
    ).select(
        "SK_Geography",
        "AddressID",
        "AddressLine1",
        "AddressLine2",
        "City",
        "StateProvinceID",
        "StateProvinceCode",
        F.coalesce("_state", F.lit(UNKNOWN)).alias("StateProvinceName"),
        "CountryRegionCode",
        F.coalesce("_country", F.lit(UNKNOWN)).alias("CountryRegionName"),
        "TerritoryID",
        "Territoryname",
        F.coalesce("_group", F.lit(UNKNOWN)).alias("TerritoryGroup"),
    )


def dim_ship_method(silver: Silver) -> DataFrame:
    return surrogate_key(silver["ShipMethod"], "ShipMethodID", "SK_ShipMethod").select(
        "SK_ShipMethod",
        "ShipMethodID",
        F.col("Name").alias("ShipMethodName"),
        "ShipBase",
        "ShipRate",
    )


def dim_credit_card(silver: Silver) -> DataFrame:
    """Cards with all but the last digits and the expiry masked."""
    shown = last_characters(F.col("CardNumber"), CARD_DIGITS_SHOWN)
    return surrogate_key(silver["CreditCard"], "CreditCardID", "SK_CreditCard").select(
        "SK_CreditCard",
        "CreditCardID",
        "CardType",
        F.concat(F.lit(CARD_MASK), shown).alias("CardNumberMasked"),
        F.lit(EXPIRY_MONTH_MASK).alias("ExpMonth"),
        F.lit(EXPIRY_YEAR_MASK).alias("ExpYear"),
    )


# dimension: (business key, surrogate key, silver table it numbers)
DIMENSION_KEYS = {
    "DimProduct": ("ProductID", "SK_Product", "Product"),
    "DimCustomer": ("CustomerID", "SK_Customer", "Customer"),
    "DimGeography": ("AddressID", "SK_Geography", "Address"),
    "DimShipMethod": ("ShipMethodID", "SK_ShipMethod", "ShipMethod"),
    "DimCreditCard": ("CreditCardID", "SK_CreditCard", "CreditCard"),
}

# dimension: the silver tables it reads
DIMENSION_TABLES = {
    "DimProduct": ("Product", "ProductSubcategory", "ProductCategory"),
    "DimCustomer": ("Customer", "Person", "Store"),
    "DimGeography": ("Address", "StateProvince", "CountryRegion", "SalesTerritory"),
    "DimShipMethod": ("ShipMethod",),
    "DimCreditCard": ("CreditCard",),
}


def build_dimension(name: str, silver: Silver, as_of: datetime | None = None) -> DataFrame:
    if name == "DimProduct":
        return dim_product(silver, as_of)
    if name == "DimCustomer":
        return dim_customer(silver, as_of)
    return {
        "DimGeography": dim_geography,
        "DimShipMethod": dim_ship_method,
        "DimCreditCard": dim_credit_card,
    }[name](silver)


def key_map(name: str, silver: Silver) -> DataFrame:
    """Business key and surrogate key of a dimension, without its attributes."""
    key, surrogate, table = DIMENSION_KEYS[name]
    return surrogate_key(silver[table].select(key), key, surrogate)


def _keys(dimensions: Dimensions, name: str, alias: str | None = None) -> DataFrame:
    key, surrogate, _ = DIMENSION_KEYS[name]
    return dimensions[name].select(key, F.col(surrogate).alias(alias or surrogate))


def fact_sales(
    silver: Silver, dimensions: Dimensions, with_card: bool = True, heavy: Heavy | None = None
) -> DataFrame:
    """One row per order line, with the keys of its dimensions and its measures.

    Whatever depends on the order alone is looked up on the orders, several
    times fewer than the lines; the lines are shuffled once, by order. Lines
    without a customer, product, ship-to address or ship method are lost, see
    ``fact_join_loss``; a card is optional. A reader who does not want the
    card's key can spare its join with ``with_card=False``. ``heavy`` names orders (SalesOrderID) and
    products (ProductID) so frequent among the lines that their rows are to be dealt to many tasks, see ``heavy_keys``.
    """
    heavy = heavy or {}
    orders = silver["SalesOrderHeader"].select(
        F.col("SalesOrderID").alias("OrderKey"),
        date_key(F.col("OrderDate")).alias("OrderDateKey"),
        date_key(F.col("DueDate")).alias("DueDateKey"),
        date_key(F.col("ShipDate")).alias("ShipDateKey"),
        F.when(F.col("OnlineOrderFlag"), CHANNEL_ONLINE)
        .otherwise(CHANNEL_RESELLER)
        .alias("SalesChannel"),
        F.col("SubTotal").alias("OrderSubTotal"),
        F.col("TaxAmt").alias("TaxAmount"),
        "Freight",
        "CustomerID",
        "ShipToAddressID",
        "ShipMethodID",
        "CreditCardID",
    )
    orders = required_lookup(
        orders, "ShipMethodID", _keys(dimensions, "DimShipMethod"), "ShipMethodID"
    )
    orders = required_lookup(
        orders,
        "ShipToAddressID",
        _keys(dimensions, "DimGeography", "ShipGeographyKey"),
        "AddressID",
    )
    orders = required_lookup(orders, "CustomerID", _keys(dimensions, "DimCustomer"), "CustomerID")
    if with_card:
        orders = optional_lookup(
            orders,
            "CreditCardID",
            _keys(dimensions, "DimCreditCard"),
            "CreditCardID",
            spread_by="OrderKey",
        )
    lines = silver["SalesOrderDetail"].select(
        F.col("SalesOrderDetailID").alias("SalesDetailKey"),
        "SalesOrderID",
        "ProductID",
        F.col("OrderQty").alias("OrderQuantity"),
        "UnitPrice",
        "UnitPriceDiscount",
        "LineTotal",
    )
    products = _keys(dimensions, "DimProduct")
    lines = required_lookup(lines, "ProductID", products, "ProductID", heavy.get("ProductID", ()))
    orders = orders.withColumn("_order", F.col("OrderKey"))
    fact = required_lookup(lines, "SalesOrderID", orders, "_order", heavy.get("SalesOrderID", ()))
    return fact.select(
        "SalesDetailKey",
        "OrderKey",
        "OrderDateKey",
        "DueDateKey",
        "ShipDateKey",
        "SK_Customer",
        "SK_Product",
        "ShipGeographyKey",
        "SK_ShipMethod",
        *(["SK_CreditCard"] if with_card else []),
        "SalesChannel",
        "OrderQuantity",
        "UnitPrice",
        "UnitPriceDiscount",
        "LineTotal",
        "OrderSubTotal",
        "TaxAmount",
        "Freight",
    )


def fact_join_loss(silver: Silver, dimensions: Dimensions) -> DataFrame:
    """(Dimension, LostLines): silver lines which the fact's inner joins drop.

    Lines without an order count for the order; the others count for every
    dimension they miss, so that a line may count more than once. The lines
    are reduced to one row per order before they meet the orders.
    """

    def flagged(df: DataFrame, fk: str, name: str, missing: str) -> DataFrame:
        keys = dimensions[name].select(DIMENSION_KEYS[name][0]).withColumn(missing, F.lit(False))
        found = optional_lookup(df, fk, keys, DIMENSION_KEYS[name][0], spread_by="SalesOrderID")
        return found.withColumn(missing, F.coalesce(missing, F.lit(True)))

    orders = silver["SalesOrderHeader"].select(
        "SalesOrderID", "CustomerID", "ShipToAddressID", "ShipMethodID"
    )
    orders = flagged(orders, "ShipMethodID", "DimShipMethod", "_no_method")
    orders = flagged(orders, "ShipToAddressID", "DimGeography", "_no_address")
    orders = flagged(orders, "CustomerID", "DimCustomer", "_no_customer")
    orders = orders.select(
        F.col("SalesOrderID").alias("_order"), "_no_method", "_no_address", "_no_customer"
    )
    lines = flagged(
        silver["SalesOrderDetail"].select("SalesOrderID", "ProductID"),
        "ProductID",
        "DimProduct",
        "_no_product",
    )
    per_order = lines.groupBy("SalesOrderID").agg(
        F.count(F.lit(1)).alias("_lines"), F.count_if("_no_product").alias("_without_product")
    )
    known = F.col("_order").isNotNull()
    lost = {
        "SalesOrderHeader": F.when(~known, F.col("_lines")),
        "DimCustomer": F.when(F.col("_no_customer"), F.col("_lines")),
        "DimProduct": F.when(known, F.col("_without_product")),
        "DimGeography": F.when(F.col("_no_address"), F.col("_lines")),
        "DimShipMethod": F.when(F.col("_no_method"), F.col("_lines")),
    }
    sums = per_order.join(orders, F.col("SalesOrderID") == F.col("_order"), "left").agg(
        *[F.coalesce(F.sum(value), F.lit(0)).alias(name) for name, value in lost.items()]
    )
    rows = [
        F.struct(F.lit(name).alias("Dimension"), F.col(name).alias("LostLines")) for name in lost
    ]
    return sums.select(F.inline(F.array(*rows)))


def gold_row_counts(bronze: DataFrame, silver: DataFrame, fact: DataFrame) -> DataFrame:
    """(Layer, Row_Count) of the order lines in each layer."""
    return layer_counts({BRONZE_LINES: bronze, SILVER_LINES: silver, GOLD_LINES: fact})


def all_key_maps(silver: Silver) -> DataFrame:
    """(Dimension, BusinessKey, SurrogateKey) of every numbered dimension."""
    return reduce(
        DataFrame.unionByName,
        [
            key_map(name, silver).select(
                F.lit(name).alias("Dimension"),
                F.col(key).cast("bigint").alias("BusinessKey"),
                F.col(surrogate).alias("SurrogateKey"),
            )
            for name, (key, surrogate, _) in DIMENSION_KEYS.items()
        ],
    )
