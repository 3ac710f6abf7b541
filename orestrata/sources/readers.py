"""Readers of the operational tables. Each is called with a table name."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orestrata.operators.ranks import row_numbers

Source = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class FileSource:
    """One folder or file per table, in any format Spark reads."""

    root: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    suffix: str = ""

    def __call__(self, spark: SparkSession, table: str) -> DataFrame:
        path = f"{self.root.rstrip('/')}/{table}{self.suffix}"
        return spark.read.format(self.format).options(**self.options).load(path)


@dataclass(frozen=True)
class CatalogSource:
    """Tables of another catalog database."""

    database: str

    def __call__(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.table(f"`{self.database}`.`{table}`")


@dataclass(frozen=True)
class JdbcSplit:
    """How one table is read in parallel: by ranges of a numeric or date column."""

    column: str
    lower: str
    upper: str
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.partitions),
        }


def _literal(value: object) -> str:
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, (date, datetime)):
        return f"'{value.isoformat(sep=' ') if isinstance(value, datetime) else value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


@dataclass(frozen=True)
class JdbcRanges:
    """How one table is read in parallel: by ranges between given keys of any orderable type.

    Unlike strides of equal width, ranges between quantiles hold about as many rows each, wherever the
    keys lie. The first range has the rows without a key as well.
    """

    column: str
    bounds: tuple = ()

    @classmethod
    def from_keys(cls, keys: DataFrame, column: str, partitions: int) -> JdbcRanges:
        """Ranges between quantiles of known keys, e.g. of a sample, or of the bronze table as last loaded."""
        ranked = keys.where(F.col(column).isNotNull()).select(column)
        if dict(ranked.dtypes)[column] in ("tinyint", "smallint", "int", "bigint", "float", "double", "date"):
            shares = [k / partitions for k in range(1, partitions)]
            found = ranked.agg(F.percentile_approx(column, shares, 100 * partitions).alias("cuts")).first().cuts
            return cls(column, tuple(sorted(set(found or ()))))
        numbered = row_numbers(ranked, [column], "place")
        rows = numbered.count()
        places = {max(1, rows * k // partitions) for k in range(1, partitions)} if rows else {0}
        cuts = numbered.where(F.col("place").isin(*places)).select(column).distinct().orderBy(column)
        return cls(column, tuple(row[0] for row in cuts.collect()))

    def predicates(self) -> list[str]:
        """One condition per range; every row meets exactly one."""
        if not self.bounds:
            return ["1 = 1"]
        cuts = [_literal(bound) for bound in self.bounds]
        inner = [f"{self.column} > {low} AND {self.column} <= {high}" for low, high in zip(cuts, cuts[1:])]
        return [f"{self.column} <= {cuts[0]} OR {self.column} IS NULL", *inner, f"{self.column} > {cuts[-1]}"]


class UnsplitTable(ValueError):
    """A table would be read through one connection and was not declared small."""


@dataclass(frozen=True)
class JdbcSource:
    """Tables of a database. ``schemas`` says in which schema a table lives.

    A table without a split is read through one connection, by one task. That is refused unless the
    table is declared ``small``.
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    schemas: Mapping[str, str] = field(default_factory=dict)
    splits: Mapping[str, JdbcSplit | JdbcRanges] = field(default_factory=dict)
    fetch_size: int = 10_000
    small: Iterable[str] = ()

    def options(self, table: str) -> dict[str, str]:
        schema = self.schemas.get(table)
        options = {
            "url": self.url,
            "dbtable": f"{schema}.{table}" if schema else table,
            "fetchsize": str(self.fetch_size),
            **self.properties,
        }
        if isinstance(self.splits.get(table), JdbcSplit):
            options.update(self.splits[table].options())
        return options

    def __call__(self, spark: SparkSession, table: str) -> DataFrame:
        split = self.splits.get(table)
        if split is None and table not in self.small:
            raise UnsplitTable(f"{table} has no split: give it one, or declare it small")
        options = self.options(table)
        if isinstance(split, JdbcRanges):
            url, name = options.pop("url"), options.pop("dbtable")
            return spark.read.jdbc(url, name, predicates=split.predicates(), properties=options)
        return spark.read.format("jdbc").options(**options).load()


@dataclass(frozen=True)
class FrameSource:
    """DataFrames built elsewhere, by table name."""

    frames: Mapping[str, DataFrame]

    def __call__(self, spark: SparkSession, table: str) -> DataFrame:
        return self.frames[table]
