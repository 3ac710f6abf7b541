"""Every operator as a query over the given tables.

A query builds what it needs from the Parquet files, whole tables throughout.
The silver layer of the checks sets violating rows aside (``quarantine``), as
the seeded defects would otherwise stop each load.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from datetime import datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orestrata.fixed_values import BRONZE, DIMENSIONS, FACT, GOLD, LAYERS, SILVER, TABLES
from orestrata.operators.calendar import calendar_coverage, dim_date, dim_date_spanning
from orestrata.operators.conform import conform
from orestrata.operators.conform import violations as constraint_violations
from orestrata.operators.expectations import FAILED, QUARANTINE, UNFIT, Expectation, violation_report
from orestrata.operators.ingest import load_isolated
from orestrata.operators.reconcile import sample
from orestrata.plans import marts
from orestrata.plans.bronze import bronze_row_counts, bronze_table, load_bronze
from orestrata.plans.gold import (
    DIMENSION_KEYS,
    DIMENSION_TABLES,
    all_key_maps,
    build_dimension,
    fact_join_loss,
    fact_sales,
    gold_row_counts,
    key_map,
)
from orestrata.plans.profile import PROFILES, profile_report
from orestrata.plans.silver import (
    SAMPLED,
    VALIDATIONS,
    silver_row_counts,
    silver_tables,
)
from orestrata.session import tune
from orestrata.sources.layers import CatalogLayers, PathLayers
from orestrata.sources.overlap import overlap
from orestrata.sources.shared import new_folder, settle
from orestrata_checks.bindings import GIVEN, bound_table
from orestrata_checks.contracts import BOUND

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2002, 1, 1)
ORDER_DATES = ("OrderDate", "DueDate", "ShipDate")


def snake(name: str) -> str:
    return "".join(f"_{c.lower()}" if c.isupper() else c for c in name).lstrip("_")


class Bronze(Mapping[str, DataFrame]):
    """The bronze tables of a data directory, each read when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir
        self._frames: dict[str, DataFrame] = {}

    def source(self, spark: SparkSession, table: str) -> DataFrame:
        return bound_table(spark, self.sf_dir, table)

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._frames:
            self._frames[table] = bronze_table(self.spark, self.source, table)
        return self._frames[table]

    def __iter__(self):
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)


def silver(spark: SparkSession, sf_dir: str, tables: Iterable[str]) -> dict[str, DataFrame]:
    return silver_tables(Bronze(spark, sf_dir), tables, QUARANTINE, BOUND)


# --- bronze -----------------------------------------------------------------


def bronze_query(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return Bronze(spark, sf_dir)[table]


def bronze_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_row_counts(spark, Bronze(spark, sf_dir))


def load_isolated_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables stored, and one more whose source does not exist."""
    bronze = Bronze(spark, sf_dir)
    layers = PathLayers(spark, new_folder(spark))

    def load(table: str) -> DataFrame:
        return layers.write(bronze[table], BRONZE, table)

    loads = {table: partial(load, table) for table in TABLES}
    loads["Missing"] = partial(load, "Missing")
    return load_isolated(spark, loads).drop("Error")


def full_refresh_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of the stored tables after two loads into the same place."""
    bronze = Bronze(spark, sf_dir)
    layers = PathLayers(spark, new_folder(spark))
    load_bronze(spark, bronze.source, layers)
    load_bronze(spark, bronze.source, layers)
    return bronze_row_counts(spark, {table: layers.read(BRONZE, table) for table in TABLES})


def create_layers_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(LayerName, TableName, Rows) of the catalog after the given tables were stored in each layer, as the catalog has it."""
    layers = CatalogLayers(tune(spark), new_folder(spark), prefix=f"layers_{uuid.uuid4().hex}_")
    layers.create()
    given = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in GIVEN}
    staged = overlap({name: partial(layers.stage, df, BRONZE, name) for name, df in given.items()})
    layers.commit(list(staged.values()))
    layers.write(given["customer"], SILVER, "customer")
    layers.write(given["nation"], GOLD, "nation")
    parts = []
    for layer in LAYERS:
        for table in spark.catalog.listTables(layers.database(layer)):
            rows = spark.table(f"`{layers.database(layer)}`.`{table.name}`").agg(F.count(F.lit(1)).alias("Rows"))
            parts.append(rows.select(F.lit(layer).alias("LayerName"), F.lit(table.name).alias("TableName"), "Rows"))
    return reduce(DataFrame.unionByName, parts)


# --- profiling --------------------------------------------------------------


def profile_query(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return PROFILES[name](Bronze(spark, sf_dir))


def profile_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_report(Bronze(spark, sf_dir))


# --- silver -----------------------------------------------------------------


def silver_query(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return silver(spark, sf_dir, [table])[table]


def rejects_query(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Rejected rows; the failed constraints joined to one text."""
    rejects = conform(Bronze(spark, sf_dir)[table], BOUND[table], QUARANTINE).rejects
    return rejects.withColumn(FAILED, F.array_join(FAILED, ",")).drop(UNFIT)


def unfit_query(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Rejected rows with the values that did not fit, as text."""
    rejects = conform(Bronze(spark, sf_dir)[table], BOUND[table], QUARANTINE).rejects
    named = F.transform(UNFIT, lambda each: F.concat(each["Column"], F.lit("="), each["Value"]))
    return rejects.withColumns({FAILED: F.array_join(FAILED, ","), UNFIT: F.array_join(named, ",")})


def violations(
    spark: SparkSession, sf_dir: str, tables: Iterable[str], constraint: str
) -> DataFrame:
    """Violations of the constraints whose name begins with ``constraint``."""
    bronze = Bronze(spark, sf_dir)
    steps = {
        table: partial(constraint_violations, bronze[table], BOUND[table], constraint) for table in tables
    }
    return reduce(DataFrame.unionByName, overlap(steps).values())


def unique_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in conflict about their key, of the 14 tables and the calendar."""
    days = dim_date_query(spark, sf_dir)
    repeated = days.groupBy("DateKey").agg(F.count(F.lit(1)).alias("_rows"))
    unique = Expectation("PK_DimDate", F.col("DateKey").isNotNull() & (F.col("_rows") == 1))
    calendar = violation_report(repeated, "DimDate", [unique])
    return violations(spark, sf_dir, TABLES, "PK_").unionByName(calendar)


# --- validation -------------------------------------------------------------


def silver_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_row_counts(Bronze(spark, sf_dir), silver(spark, sf_dir, TABLES))


def validation_query(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    check, tables = VALIDATIONS[name]
    return check(silver(spark, sf_dir, tables))


def sample_query(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return sample(silver_query(spark, sf_dir, table), BOUND[table].keys)


# --- gold -------------------------------------------------------------------


def surrogate_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = [table for _, _, table in DIMENSION_KEYS.values()]
    return all_key_maps(silver(spark, sf_dir, numbered))


def dimension_query(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return build_dimension(name, silver(spark, sf_dir, DIMENSION_TABLES[name]), AS_OF)


def dim_date_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar of the years which the orders touch."""
    orders = silver_query(spark, sf_dir, "SalesOrderHeader")
    return dim_date_spanning(orders, ORDER_DATES)


def coverage_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a calendar of the years 1996 to 1999 lacks of the orders' dates, and those outside 1996 to 2000."""
    orders = silver_query(spark, sf_dir, "SalesOrderHeader")
    return calendar_coverage(orders, ORDER_DATES, dim_date(spark, "1996-01-01", "1999-12-31"), 1996, 2000)


def star(
    spark: SparkSession, sf_dir: str, with_card: bool, described: Iterable[str] = ()
) -> tuple[dict[str, DataFrame], dict[str, DataFrame], DataFrame]:
    """Silver tables, stored dimensions and raw lines as the fact needs them.

    Dimensions which only filter and number the fact are stored as key maps,
    those in ``described`` with their attributes. No step waits for another.
    """
    bronze = Bronze(spark, sf_dir)

    def dimension(name: str) -> tuple[dict[str, DataFrame], DataFrame]:
        if name in described:
            rows = silver_tables(bronze, DIMENSION_TABLES[name], QUARANTINE, BOUND)
            return rows, settle(build_dimension(name, rows, AS_OF))
        rows = silver_tables(bronze, [DIMENSION_KEYS[name][2]], QUARANTINE, BOUND)
        return rows, settle(key_map(name, rows))

    def lines() -> tuple[dict[str, DataFrame], DataFrame]:
        return silver_tables(bronze, ["SalesOrderDetail"], QUARANTINE, BOUND), bronze["SalesOrderDetail"]

    def orders() -> tuple[dict[str, DataFrame], None]:
        return silver_tables(bronze, ["SalesOrderHeader"], QUARANTINE, BOUND), None

    names = [name for name in DIMENSION_KEYS if with_card or name != "DimCreditCard"]
    done = overlap(
        {"lines": lines, "orders": orders} | {name: partial(dimension, name) for name in names}
    )
    rows = {table: df for tables, _ in done.values() for table, df in tables.items()}
    return rows, {name: done[name][1] for name in names}, done["lines"][1]


def fact_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, dimensions, _ = star(spark, sf_dir, with_card=True)
    return fact_sales(rows, dimensions)


def gold_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, dimensions, raw_lines = star(spark, sf_dir, with_card=True)
    return gold_row_counts(raw_lines, rows["SalesOrderDetail"], fact_sales(rows, dimensions))


def join_loss_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, dimensions, _ = star(spark, sf_dir, with_card=False)
    return fact_join_loss(rows, dimensions)


# --- business questions -----------------------------------------------------


def fact_question(
    spark: SparkSession, sf_dir: str, question: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    rows, dimensions, _ = star(spark, sf_dir, with_card=False)
    return question(fact_sales(rows, dimensions, with_card=False))


def star_question(
    spark: SparkSession,
    sf_dir: str,
    question: Callable[[DataFrame, Mapping[str, DataFrame]], DataFrame],
    described: str,
) -> DataFrame:
    rows, dimensions, _ = star(spark, sf_dir, with_card=False, described=[described])
    return question(fact_sales(rows, dimensions, with_card=False), dimensions)


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for table in TABLES:
        found[f"bronze_{snake(table)}"] = partial(bronze_query, table=table)
    found["bronze_row_counts"] = bronze_counts_query
    found["create_layers"] = create_layers_query
    found["load_isolated"] = load_isolated_query
    found["full_refresh"] = full_refresh_query

    for name in PROFILES:
        found[f"prof_{name}"] = partial(profile_query, name=name)
    found["profile_report"] = profile_report_query

    for table in TABLES:
        found[f"silver_{snake(table)}"] = partial(silver_query, table=table)
    for table in ("SalesOrderHeader", "SalesOrderDetail"):
        found[f"silver_{snake(table)}_rejects"] = partial(rejects_query, table=table)
    found["silver_credit_card_rejects"] = partial(unfit_query, table="CreditCard")

    found["expect_unique_key"] = unique_key_query
    required = [t for t, contract in BOUND.items() if any(f.required for f in contract.fields)]
    found["expect_not_null"] = partial(violations, tables=required, constraint="NN_")
    for name, table, constraint in (
        ("due_after_order", "SalesOrderHeader", "CK_SalesOrderHeader_DueDate"),
        ("ship_after_order", "SalesOrderHeader", "CK_SalesOrderHeader_ShipDate"),
        ("qty_positive", "SalesOrderDetail", "CK_SalesOrderDetail_OrderQty"),
        ("unit_price_nonnegative", "SalesOrderDetail", "CK_SalesOrderDetail_UnitPrice"),
    ):
        found[f"expect_{name}"] = partial(violations, tables=[table], constraint=constraint)
    found["expect_type_fit"] = partial(violations, tables=TABLES, constraint="FIT_")

    found["val_silver_row_counts"] = silver_counts_query
    for name in VALIDATIONS:
        found[f"val_{name}"] = partial(validation_query, name=name)
    for table in SAMPLED:
        found[f"sample_{snake(table)}"] = partial(sample_query, table=table)

    found["surrogate_key"] = surrogate_key_query
    for name in DIMENSIONS:
        found[snake(name)] = (
            dim_date_query if name == "DimDate" else partial(dimension_query, name=name)
        )
    found["calendar_coverage"] = coverage_query
    found[snake(FACT)] = fact_query
    found["val_gold_row_counts"] = gold_counts_query
    found["fact_join_loss"] = join_loss_query

    for name, question in (
        ("total_revenue", marts.total_revenue),
        ("distinct_orders", marts.distinct_orders),
        ("unique_customers", marts.unique_customers),
        ("avg_order_value", marts.average_order_value),
    ):
        found[f"bq_{name}"] = partial(fact_question, question=question)
    for name, question, described in (
        ("top5_territories", marts.top_territories, "DimGeography"),
        ("top_category", marts.top_category, "DimProduct"),
        ("category_subcategory", marts.category_subcategory, "DimProduct"),
    ):
        found[f"bq_{name}"] = partial(star_question, question=question, described=described)
    return found
