"""Fixed values.

Names, labels and constants which readers of the warehouse rely on and which
therefore must not vary between builds. Everything else in the package is
derived from these.
"""

BRONZE, SILVER, GOLD = "bronze", "silver", "gold"
LAYERS = (BRONZE, SILVER, GOLD)

TABLES = (
    "SalesOrderHeader",
    "SalesOrderDetail",
    "Customer",
    "Person",
    "Store",
    "SalesTerritory",
    "Product",
    "ProductSubcategory",
    "ProductCategory",
    "Address",
    "StateProvince",
    "CountryRegion",
    "ShipMethod",
    "CreditCard",
)

# The schema of the operational database in which each table lives.
SOURCE_SCHEMAS = {
    "SalesOrderHeader": "Sales",
    "SalesOrderDetail": "Sales",
    "Customer": "Sales",
    "Store": "Sales",
    "SalesTerritory": "Sales",
    "CreditCard": "Sales",
    "Person": "Person",
    "Address": "Person",
    "StateProvince": "Person",
    "CountryRegion": "Person",
    "Product": "Production",
    "ProductSubcategory": "Production",
    "ProductCategory": "Production",
    "ShipMethod": "Purchasing",
}

DIMENSIONS = (
    "DimProduct",
    "DimCustomer",
    "DimGeography",
    "DimShipMethod",
    "DimCreditCard",
    "DimDate",
)
FACT = "FactSales"

# Columns taken from a source which holds more, or holds typed documents.
SOURCE_COLUMNS = {
    "Person": (
        "BusinessEntityID",
        "PersonType",
        "NameStyle",
        "Title",
        "FirstName",
        "MiddleName",
        "LastName",
        "Suffix",
        "EmailPromotion",
        "AdditionalContactInfo",
        "Demographics",
        "rowguid",
        "ModifiedDate",
    ),
    "Store": (
        "BusinessEntityID",
        "Name",
        "SalesPersonID",
        "Demographics",
        "rowguid",
        "ModifiedDate",
    ),
}
DOCUMENT_COLUMNS = {
    "Person": ("AdditionalContactInfo", "Demographics"),
    "Store": ("Demographics",),
}

# Stand-ins for missing values.
UNKNOWN = "Unknown"
NOT_AVAILABLE = "N/A"
INDIVIDUAL_CUSTOMER = "Individual Customer"

CUSTOMER_IS_BOTH = "Store & Individual"
CUSTOMER_IS_STORE = "Store"
CUSTOMER_IS_INDIVIDUAL = "Individual"

CHANNEL_ONLINE = "Online"
CHANNEL_RESELLER = "Reseller / Store"

CARD_MASK = "XXXX-XXXX-XXXX-"
CARD_DIGITS_SHOWN = 4
EXPIRY_MONTH_MASK = "**"
EXPIRY_YEAR_MASK = "****"

CALENDAR_START = "2010-01-01"
CALENDAR_END = "2025-12-31"

# Constraints that have a published name.
CHECK_DUE_DATE = "CK_SalesOrderHeader_DueDate"
CHECK_SHIP_DATE = "CK_SalesOrderHeader_ShipDate"
CHECK_ORDER_QTY = "CK_SalesOrderDetail_OrderQty"
CHECK_UNIT_PRICE = "CK_SalesOrderDetail_UnitPrice"

# Labels of the layer comparison.
BRONZE_LINES = "Bronze Sales Details"
SILVER_LINES = "Silver Sales Details"
GOLD_LINES = "Gold FactSales Rows"

SAMPLE_ROWS = 10
TOP_TERRITORIES = 5
