"""Build the warehouse from files or a database: ``spark-submit`` this, or ``python -m orestrata``."""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import SparkSession

from orestrata.fixed_values import SOURCE_SCHEMAS, TABLES
from orestrata.operators.expectations import FAIL, POLICIES
from orestrata.plans.contracts import CONTRACTS, wide_keys
from orestrata.plans.warehouse import build_warehouse
from orestrata.session import tune
from orestrata.sources.layers import CatalogLayers, PathLayers
from orestrata.sources.readers import FileSource, JdbcSource, JdbcSplit, Source


def split(text: str) -> tuple[str, JdbcSplit]:
    """TABLE=COLUMN,LOWER,UPPER,PARTITIONS"""
    table, _, how = text.partition("=")
    column, lower, upper, partitions = how.split(",")
    if table not in TABLES:
        raise argparse.ArgumentTypeError(f"there is no table {table}")
    return table, JdbcSplit(column, lower, upper, int(partitions))


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="orestrata", description=__doc__)
    parser.add_argument("source", help="folder with one file or folder per source table, or a jdbc: address")
    parser.add_argument("target", help="root folder of the warehouse")
    parser.add_argument("--format", default="parquet", help="format of the source files")
    parser.add_argument("--suffix", default="", help="what follows a table's name, e.g. .parquet")
    parser.add_argument("--property", action="append", default=[], metavar="NAME=VALUE", help="of a database, e.g. user")
    parser.add_argument("--split", action="append", default=[], type=split, metavar="TABLE=COLUMN,LOWER,UPPER,PARTITIONS")
    parser.add_argument("--small", nargs="*", default=[], help="tables of a database that one connection may read")
    parser.add_argument("--policy", choices=POLICIES, default=FAIL)
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="start of validity")
    parser.add_argument("--calendar", nargs=2, metavar=("FIRST", "LAST"), help="days of DimDate")
    parser.add_argument("--fact-by-year", action="store_true")
    parser.add_argument("--wide-keys", action="store_true", help="64-bit keys and references")
    parser.add_argument("--catalog", action="store_true", help="create catalog tables")
    return parser.parse_args(given)


def source(given: argparse.Namespace) -> Source:
    if not given.source.startswith("jdbc:"):
        return FileSource(given.source, given.format, suffix=given.suffix)
    properties = dict(each.split("=", 1) for each in given.property)
    return JdbcSource(given.source, properties, SOURCE_SCHEMAS, dict(given.split), small=tuple(given.small))


def main() -> None:
    given = arguments()
    spark = tune(SparkSession.builder.appName("orestrata").getOrCreate())
    layers = (CatalogLayers if given.catalog else PathLayers)(spark, given.target)
    report = build_warehouse(
        spark,
        source(given),
        layers,
        given.policy,
        given.as_of,
        given.calendar,
        given.fact_by_year,
        wide_keys() if given.wide_keys else CONTRACTS,
    )
    for part in (
        report.loads,
        report.bronze_rows,
        report.profile,
        *report.findings.values(),
        report.violations.where("Violations > 0"),
        report.silver_rows,
        report.integrity,
        report.calendar,
        *report.samples.values(),
        report.gold_rows,
        report.join_loss,
    ):
        part.show(100, truncate=False)


if __name__ == "__main__":
    main()
