"""The contracts of the 14 silver tables.

Table, column and constraint names, types and which columns are required are
fixed values: the gold layer and its readers rely on them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import functions as F

from orestrata.fixed_values import (
    CHECK_DUE_DATE,
    CHECK_ORDER_QTY,
    CHECK_SHIP_DATE,
    CHECK_UNIT_PRICE,
    UNKNOWN,
)
from orestrata.functions.rules import (
    blank_to_default,
    negative_to_zero,
    null_or_negative_to_zero,
    to_date,
    trim,
    upper_trim,
)
from orestrata.functions.stored_types import (
    BIGINT,
    BIT,
    DATE,
    DOCUMENT,
    INT,
    MONEY,
    SMALLINT,
    TINYINT,
    decimal,
    fixed_text,
    text,
)
from orestrata.operators.conform import Check, Contract, Field

known = blank_to_default(UNKNOWN)
known_upper = blank_to_default(UNKNOWN, upper_trim)

PRODUCT_CATEGORY = Contract(
    "ProductCategory",
    "ProductCategoryID",
    (
        Field("ProductCategoryID", INT),
        Field("Name", text(50), upper_trim, required=True),
    ),
)

PRODUCT_SUBCATEGORY = Contract(
    "ProductSubcategory",
    "ProductSubcategoryID",
    (
        Field("ProductSubcategoryID", INT),
        Field("ProductCategoryID", INT, required=True),
        Field("Name", text(50), upper_trim, required=True),
    ),
)

PRODUCT = Contract(
    "Product",
    "ProductID",
    (
        Field("ProductID", INT),
        Field("Name", text(100), trim),
        Field("ProductNumber", text(25), trim),
        Field("Color", text(20), known_upper, required=True),
        Field("Size", text(5)),
        Field("Weight", decimal(8, 2)),
        Field("ProductLine", fixed_text(2)),
        Field("Class", fixed_text(2)),
        Field("Style", fixed_text(2)),
        Field("StandardCost", MONEY, negative_to_zero, required=True),
        Field("ListPrice", MONEY, null_or_negative_to_zero, required=True),
        Field("ProductSubcategoryID", INT),
    ),
)

SALES_TERRITORY = Contract(
    "SalesTerritory",
    "TerritoryID",
    (
        Field("TerritoryID", INT),
        Field("Name", text(50), trim),
        Field("CountryRegionCode", text(10), upper_trim),
        Field("Group", text(50), upper_trim),
        Field("SalesYTD", MONEY),
        Field("SalesLastYear", MONEY),
        Field("CostYTD", MONEY),
        Field("CostLastYear", MONEY),
    ),
)

COUNTRY_REGION = Contract(
    "CountryRegion",
    "CountryRegionCode",
    (
        Field("CountryRegionCode", text(10), upper_trim),
        Field("Name", text(50), trim),
    ),
)

STATE_PROVINCE = Contract(
    "StateProvince",
    "StateProvinceID",
    (
        Field("StateProvinceID", INT),
        Field("StateProvinceCode", fixed_text(3), upper_trim),
        Field("CountryRegionCode", text(10), upper_trim),
        Field("Name", text(50), trim),
        Field("TerritoryID", INT),
    ),
)

ADDRESS = Contract(
    "Address",
    "AddressID",
    (
        Field("AddressID", INT),
        Field("AddressLine1", text(60), trim),
        Field("AddressLine2", text(60), trim),
        Field("City", text(50), known, required=True),
        Field("StateProvinceID", INT),
        Field("PostalCode", text(15), known, required=True),
    ),
)

# Documents do not compare, so copies of a person or store are conflicts.
PERSON = Contract(
    "Person",
    "BusinessEntityID",
    (
        Field("BusinessEntityID", INT),
        Field("PersonType", fixed_text(2), upper_trim),
        Field("Title", text(8), upper_trim),
        Field("FirstName", text(50), known, required=True),
        Field("MiddleName", text(50), trim),
        Field("LastName", text(50), known, required=True),
        Field("Suffix", text(10), upper_trim),
        Field("EmailPromotion", INT),
        Field("AdditionalContactInfo", DOCUMENT),
        Field("Demographics", DOCUMENT),
    ),
    distinct=False,
)

STORE = Contract(
    "Store",
    "BusinessEntityID",
    (
        Field("BusinessEntityID", INT),
        Field("Name", text(100), trim),
        Field("SalesPersonID", INT),
        Field("Demographics", DOCUMENT),
    ),
    distinct=False,
)

CUSTOMER = Contract(
    "Customer",
    "CustomerID",
    (
        Field("CustomerID", INT),
        Field("PersonID", INT),
        Field("StoreID", INT),
        Field("TerritoryID", INT),
        Field("AccountNumber", text(20), trim),
    ),
)

SALES_ORDER_HEADER = Contract(
    "SalesOrderHeader",
    "SalesOrderID",
    (
        Field("SalesOrderID", INT),
        Field("RevisionNumber", TINYINT),
        Field("OrderDate", DATE, to_date),
        Field("DueDate", DATE, to_date),
        Field("ShipDate", DATE, to_date),
        Field("Status", TINYINT),
        Field("OnlineOrderFlag", BIT),
        Field("SalesOrderNumber", text(25), trim),
        Field("PurchaseOrderNumber", text(25), trim),
        Field("AccountNumber", text(20), trim),
        Field("CustomerID", INT),
        Field("SalesPersonID", INT),
        Field("TerritoryID", INT),
        Field("BillToAddressID", INT),
        Field("ShipToAddressID", INT),
        Field("ShipMethodID", INT),
        Field("CreditCardID", INT),
        Field("CreditCardApprovalCode", text(15), trim),
        Field("CurrencyRateID", INT),
        Field("SubTotal", MONEY),
        Field("TaxAmt", MONEY),
        Field("Freight", MONEY),
        Field("TotalDue", MONEY),
        Field("Comment", text(128), trim),
    ),
    checks=(
        Check(CHECK_DUE_DATE, lambda: F.col("DueDate") >= F.col("OrderDate")),
        Check(CHECK_SHIP_DATE, lambda: F.col("ShipDate") >= F.col("OrderDate")),
    ),
)

SALES_ORDER_DETAIL = Contract(
    "SalesOrderDetail",
    "SalesOrderDetailID",
    (
        Field("SalesOrderDetailID", INT),
        Field("SalesOrderID", INT),
        Field("CarrierTrackingNumber", text(25), trim),
        Field("OrderQty", SMALLINT),
        Field("ProductID", INT),
        Field("SpecialOfferID", INT),
        Field("UnitPrice", MONEY),
        Field("UnitPriceDiscount", MONEY),
        Field("LineTotal", MONEY),
    ),
    checks=(
        Check(CHECK_ORDER_QTY, lambda: F.col("OrderQty") > 0),
        Check(CHECK_UNIT_PRICE, lambda: F.col("UnitPrice") >= 0),
    ),
)

SHIP_METHOD = Contract(
    "ShipMethod",
    "ShipMethodID",
    (
        Field("ShipMethodID", INT),
        Field("Name", text(50), trim, required=True),
        Field("ShipBase", MONEY),
        Field("ShipRate", MONEY),
    ),
)

CREDIT_CARD = Contract(
    "CreditCard",
    "CreditCardID",
    (
        Field("CreditCardID", INT),
        Field("CardType", text(50), trim),
        Field("CardNumber", text(25)),
        Field("ExpMonth", TINYINT),
        Field("ExpYear", SMALLINT),
    ),
)

CONTRACTS = {
    contract.table: contract
    for contract in (
        SALES_ORDER_HEADER,
        SALES_ORDER_DETAIL,
        CUSTOMER,
        PERSON,
        STORE,
        SALES_TERRITORY,
        PRODUCT,
        PRODUCT_SUBCATEGORY,
        PRODUCT_CATEGORY,
        ADDRESS,
        STATE_PROVINCE,
        COUNTRY_REGION,
        SHIP_METHOD,
        CREDIT_CARD,
    )
}


def wide_keys(contracts: Mapping[str, Contract] = CONTRACTS) -> dict[str, Contract]:
    """The same contracts with every 32-bit integer, keys and references alike, in 64 bits."""
    return {
        table: contract.retyped(**{each.name: BIGINT for each in contract.fields if each.type == INT})
        for table, contract in contracts.items()
    }
