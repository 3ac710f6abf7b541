"""The whole build: bronze, profile, silver, validation, gold.

Each layer is stored before the next one reads it, so that every step starts
from files of known size and an executor's loss costs only its own tasks. The tables of silver, and those of
gold, take the place of the old ones together, once all of them are there.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orestrata.fixed_values import BRONZE, DIMENSIONS, FACT, GOLD, SILVER, TABLES
from orestrata.operators.calendar import PLAUSIBLE_YEARS, calendar_coverage, dim_date, dim_date_spanning
from orestrata.operators.conform import Contract
from orestrata.operators.expectations import (
    FAIL,
    FAILED,
    KEPT,
    PART,
    QUARANTINE,
    REJECTED,
    UNFIT,
    VIOLATIONS,
    ConstraintViolation,
)
from orestrata.operators.lookup import heavy_keys
from orestrata.operators.reconcile import sample
from orestrata.plans.bronze import bronze_row_counts, load_bronze
from orestrata.plans.contracts import CONTRACTS
from orestrata.plans.gold import (
    build_dimension,
    fact_join_loss,
    fact_sales,
    gold_row_counts,
)
from orestrata.plans.profile import LISTS, PROFILES, profile_report
from orestrata.plans.silver import SAMPLED, conform_tables, integrity_report, silver_row_counts
from orestrata.sources.layers import Layers, Staged
from orestrata.sources.overlap import overlap
from orestrata.sources.readers import Source
from orestrata.sources.shared import scratch

REJECTS = "_rejects"
ORDER_YEAR = "OrderYear"
ORDER_DATES = ("OrderDate", "DueDate", "ShipDate")
_HEAVY = "heavy"


class LoadFailed(Exception):
    """Not all bronze tables could be loaded; the message names those and why."""


@dataclass(frozen=True)
class BuildReport:
    """What a build found out, as DataFrames over stored tables."""

    loads: DataFrame
    bronze_rows: DataFrame
    profile: DataFrame
    findings: Mapping[str, DataFrame]  # the lists that follow the profile, by name
    violations: DataFrame
    silver_rows: DataFrame
    integrity: DataFrame
    samples: Mapping[str, DataFrame]
    calendar: DataFrame  # days the orders' dates hold, days the calendar lacks, dates far off
    gold_rows: DataFrame
    join_loss: DataFrame


def read_layer(layers: Layers, layer: str, tables: Iterable[str]) -> dict[str, DataFrame]:
    return {table: layers.read(layer, table) for table in tables}


def build_silver(
    bronze: Mapping[str, DataFrame],
    layers: Layers,
    policy: str = FAIL,
    contracts: Mapping[str, Contract] = CONTRACTS,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Store all silver tables, and under ``<table>_rejects`` what was set aside.

    After the check of its key each table is gone through once: that pass stores kept and rejected rows
    in folders of their own and counts the violations. Under the policy ``fail`` one violation in any
    table leaves all tables as they were.
    """
    spark = next(iter(bronze.values())).sparkSession

    def stage(table: str) -> tuple[list[Staged], list[tuple[str, str, int]]]:
        each = replace(conformed[table], policy=policy)
        rows, seen = each.laid_out()
        whole = layers.stage(rows, SILVER, table, [] if policy == FAIL else [PART])
        if policy == FAIL:
            return [whole], each.counted(seen)
        declared = [field for field in whole.schema.fields if field.name in each.columns]
        shown = [*declared, *[whole.schema[name] for name in (UNFIT, FAILED)]]
        staged = []
        for name, part, fields in ((table, KEPT, declared), (f"{table}{REJECTS}", REJECTED, shown)):
            staged.append(Staged(SILVER, name, f"{whole.folder}/{PART}={part}", T.StructType(fields)))
            if not seen.get[part]:  # no row, hence no folder
                spark.createDataFrame([], staged[-1].schema).write.parquet(staged[-1].folder)
        return staged, each.counted(seen)

    given = {table: bronze[table] for table in TABLES}  # read, perhaps numbered, before the scratch begins
    with scratch(spark):
        conformed = conform_tables(given, TABLES, QUARANTINE, contracts)
        done = overlap({table: partial(stage, table) for table in TABLES})
    staged = [each for parts, _ in done.values() for each in parts]
    if policy == FAIL:
        broken = {
            table: ", ".join(f"{name}: {count}" for _, name, count in counts if count)
            for table, (_, counts) in done.items()
        }
        if any(broken.values()):
            layers.discard(staged)
            found = "; ".join(f"{table} violates {names}" for table, names in broken.items() if names)
            raise ConstraintViolation(found)
    stored = layers.commit(staged)
    violations = spark.createDataFrame(
        [count for _, counts in done.values() for count in counts], VIOLATIONS
    )
    return {table: stored[table] for table in TABLES}, violations


def build_gold(
    silver: Mapping[str, DataFrame],
    layers: Layers,
    as_of: datetime | None = None,
    calendar: tuple[date | str, date | str] | None = None,
    fact_by_year: bool = False,
) -> dict[str, DataFrame]:
    """Store the dimensions, then the fact which looks them up.

    Without a ``calendar`` range the date dimension spans the years of the
    orders; dates far off (``PLAUSIBLE_YEARS``) are single days of it. ``fact_by_year`` adds a column OrderYear to the fact and lays its
    files out by it, for readers who ask for some years only.
    """
    orders = silver["SalesOrderHeader"]
    if calendar is None:
        days = dim_date_spanning(orders, ORDER_DATES, *PLAUSIBLE_YEARS)
    else:
        days = dim_date(orders.sparkSession, *calendar)
    frames = {
        name: days if name == "DimDate" else build_dimension(name, silver, as_of)
        for name in DIMENSIONS
    }
    spark = orders.sparkSession
    steps = {name: partial(layers.stage, df, GOLD, name) for name, df in frames.items()}
    steps[_HEAVY] = partial(heavy_keys, silver["SalesOrderDetail"], ["SalesOrderID", "ProductID"])
    staged = overlap(steps)
    heavy = staged.pop(_HEAVY)
    fact = fact_sales(silver, {name: each.read(spark) for name, each in staged.items()}, heavy=heavy)
    if fact_by_year:
        fact = fact.withColumn(ORDER_YEAR, F.expr("OrderDateKey div 10000").cast("int"))
    staged[FACT] = layers.stage(fact, GOLD, FACT, [ORDER_YEAR] if fact_by_year else [])
    return layers.commit(list(staged.values()))


def build_warehouse(
    spark: SparkSession,
    source: Source,
    layers: Layers,
    policy: str = FAIL,
    as_of: datetime | None = None,
    calendar: tuple[date | str, date | str] | None = None,
    fact_by_year: bool = False,
    contracts: Mapping[str, Contract] = CONTRACTS,
) -> BuildReport:
    """Run every step. Repeating it replaces all tables and gives the same ones.

    ``contracts`` declare the silver tables; ``wide_keys()`` has 64-bit keys.
    """
    layers.create()
    loads = load_bronze(spark, source, layers)
    failed = loads.where("Status <> 'loaded'").collect()
    if failed:
        raise LoadFailed("; ".join(f"{row.TableName}: {row.Error}" for row in failed))
    bronze = read_layer(layers, BRONZE, TABLES)
    silver, violations = build_silver(bronze, layers, policy, contracts)
    gold = build_gold(silver, layers, as_of, calendar, fact_by_year)
    return BuildReport(
        loads=loads,
        bronze_rows=bronze_row_counts(spark, bronze),
        profile=profile_report(bronze),
        findings={name: PROFILES[name](bronze) for name in LISTS},
        violations=violations,
        silver_rows=silver_row_counts(bronze, silver),
        integrity=integrity_report(silver),
        calendar=calendar_coverage(silver["SalesOrderHeader"], ORDER_DATES, gold["DimDate"], *PLAUSIBLE_YEARS),
        samples={table: sample(silver[table], contracts[table].keys) for table in SAMPLED},
        gold_rows=gold_row_counts(
            bronze["SalesOrderDetail"], silver["SalesOrderDetail"], gold[FACT]
        ),
        join_loss=fact_join_loss(silver, gold),
    )
