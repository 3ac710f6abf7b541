"""Data-quality checks on raw tables.

Every check is a one-row DataFrame (Table, Anomaly_Type, Affected_Row_Count
and, where it helps, an example). Rows are reduced to counts before they are
exchanged, so that a key holding a large part of a table costs no more than
any other key.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.functions.keys import CASE_INSENSITIVE, comparable

_LINK, _ROWS = "_link", "_rows"


def _labelled(df: DataFrame, table: str, anomaly: str) -> DataFrame:
    return df.select(F.lit(table).alias("Table"), F.lit(anomaly).alias("Anomaly_Type"), "*")


def duplicate_keys(df: DataFrame, keys: Sequence[str], table: str, anomaly: str) -> DataFrame:
    """How many key values occur more than once."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_ROWS)).where(F.col(_ROWS) > 1)
    return _labelled(repeated.agg(F.count(F.lit(1)).alias("Affected_Row_Count")), table, anomaly)


def is_missing(columns: Iterable[str]) -> Column:
    """True where any of the columns is NULL or blank."""
    missing = F.lit(False)
    for column in columns:
        missing = missing | F.coalesce(F.trim(F.col(column)) == "", F.lit(True))
    return missing


def predicate_check(
    df: DataFrame, table: str, anomaly: str, predicate: Column, example: Column | None = None
) -> DataFrame:
    """How many rows fulfil the predicate; with ``example`` also the least such value."""
    outputs = [F.count(F.lit(1)).alias("Affected_Row_Count")]
    if example is not None:
        outputs.append(F.min(example).alias("Example_Messy_Value"))
    return _labelled(df.where(predicate).agg(*outputs), table, anomaly)


def missing_check(df: DataFrame, columns: Iterable[str], table: str, anomaly: str) -> DataFrame:
    return predicate_check(df, table, anomaly, is_missing(columns))


@dataclass(frozen=True)
class RowCheck:
    """A predicate to be counted together with others in one scan."""

    table: str
    anomaly: str
    predicate: Column
    example: Column | None = None


def predicate_checks(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """Several predicate checks of one table in a single pass over it."""
    outputs, rows = [], []
    for number, check in enumerate(checks):
        outputs.append(F.count_if(check.predicate).alias(f"n{number}"))
        example = F.lit(None) if check.example is None else check.example
        least = F.min(F.when(check.predicate, example.cast("decimal(19,4)")))
        outputs.append(least.alias(f"x{number}"))
        rows.append(
            F.struct(
                F.lit(check.table).alias("Table"),
                F.lit(check.anomaly).alias("Anomaly_Type"),
                F.col(f"n{number}").alias("Affected_Row_Count"),
                F.col(f"x{number}").alias("Example_Messy_Value"),
            )
        )
    return df.agg(*outputs).select(F.inline(F.array(*rows)))


DUPLICATE, ORPHAN, DISTINCT, MATCHING = "duplicate", "orphan", "distinct", "matching"


@dataclass(frozen=True)
class TableCheck:
    """One of many checks answered together by ``combined_report``.

    ``key`` is what is counted in ``table``, and ``parent`` (table, key) what an ORPHAN refers to. A MATCHING check
    counts the rows that fulfil ``predicate``, with the least ``example`` of them.
    """

    kind: str
    table: str
    label: str
    anomaly: str
    key: Column | None = None
    parent: tuple[str, Column] | None = None
    nullable: bool = False
    predicate: Column | None = None
    example: Column | None = None


_ENTRY = "struct<check:int,parent:boolean,number:bigint,text:string,example:decimal(19,4)>"
_INTEGERS = {"tinyint", "smallint", "int", "bigint"}


def _entry(
    check: int, of_parent: bool, key: Column | None, integer: bool, example: Column | None, present: Column | None
) -> Column:
    """What one row says to one check, NULL if ``present`` does not hold."""
    nothing = F.lit(None)
    value = nothing if key is None else key
    entry = F.struct(
        F.lit(check).alias("check"),
        F.lit(of_parent).alias("parent"),
        (value if integer else nothing).cast("bigint").alias("number"),
        (nothing if integer else value).cast("string").alias("text"),
        (nothing if example is None else example).cast("decimal(19,4)").alias("example"),
    ).cast(_ENTRY)
    return entry if present is None else F.when(present, entry)


def combined_report(tables: Mapping[str, DataFrame], checks: Sequence[TableCheck]) -> DataFrame:
    """(Table, Anomaly_Type, Affected_Row_Count, Example_Messy_Value, Distinct_Raw_Count) of all checks.

    Each table is scanned once, however many checks it takes part in. A row gives an entry (check, side, key)
    for each of them; one aggregation, which reduces the entries to one per key and task before it
    exchanges them, has all a check asks for: how often a key occurs, and whether its parent does. So there is no
    join, and a hot key costs as much as any other.
    """

    sides = [(each.table, each.key) for each in checks if each.key is not None]
    sides += [each.parent for each in checks if each.parent is not None]
    frames = {table: tables[table] for table in dict.fromkeys([each.table for each in checks] + [t for t, _ in sides])}
    integers: dict[tuple[str, str], bool] = {}
    for table, df in frames.items():
        keys = [key for own, key in sides if own == table]
        kinds = df.select(*[key.alias(f"key{n}") for n, key in enumerate(keys)]).dtypes
        integers |= {(table, str(key)): kind in _INTEGERS for key, (_, kind) in zip(keys, kinds)}

    def integer(table: str, key: Column) -> bool:
        return integers[table, str(key)]

    entries: dict[str, list[Column]] = {}
    for number, check in enumerate(checks):
        if check.kind == MATCHING:
            entry = _entry(number, False, None, True, check.example, check.predicate)
            entries.setdefault(check.table, []).append(entry)
            continue
        numeric = integer(check.table, check.key) and (check.parent is None or integer(*check.parent))
        only_known = check.kind == DISTINCT or check.nullable
        present = check.key.isNotNull() if only_known else None
        entries.setdefault(check.table, []).append(_entry(number, False, check.key, numeric, None, present))
        if check.parent:
            table, key = check.parent
            entries.setdefault(table, []).append(_entry(number, True, key, numeric, None, key.isNotNull()))
    said = reduce(
        DataFrame.unionByName,
        [
            frames[table].select(F.explode(F.array(*asked)).alias("entry")).where("entry IS NOT NULL").select("entry.*")
            for table, asked in entries.items()
        ],
    )
    keys = said.groupBy("check", "number", "text").agg(
        F.count_if(~F.col("parent")).alias("rows"),
        F.count_if("parent").alias("parents"),
        F.min("example").alias("example"),
    )
    found = keys.groupBy("check").agg(
        F.sum("rows").alias(MATCHING),
        F.count_if(F.col("rows") > 1).alias(DUPLICATE),
        F.sum(F.when(F.col("parents") == 0, F.col("rows"))).alias(ORPHAN),
        F.count_if(F.col("rows") > 0).alias(DISTINCT),
        F.min("example").alias("example"),
    )
    asked = said.sparkSession.createDataFrame(
        [(number, each.label, each.anomaly, each.kind) for number, each in enumerate(checks)],
        "check int, Table string, Anomaly_Type string, kind string",
    )
    affected = reduce(
        lambda otherwise, kind: F.when(F.col("kind") == kind, F.coalesce(kind, F.lit(0))).otherwise(otherwise),
        (MATCHING, DUPLICATE, ORPHAN),
        F.lit(None).cast("bigint"),
    )
    different = F.when(F.col("kind") == DISTINCT, F.coalesce(DISTINCT, F.lit(0)))
    return asked.join(F.broadcast(found), "check", "left").select(  # at most a row per check
        "Table",
        "Anomaly_Type",
        affected.alias("Affected_Row_Count"),
        F.col("example").alias("Example_Messy_Value"),
        different.alias("Distinct_Raw_Count"),
    )


def distinct_count(
    df: DataFrame,
    column: str,
    table: str,
    anomaly: str,
    collation: str = CASE_INSENSITIVE,
    approximate: bool = False,
) -> DataFrame:
    """How many different values a raw text column holds, NULL not counted."""
    value = comparable(F.col(column), collation)
    counted = F.approx_count_distinct(value) if approximate else F.count_distinct(value)
    return _labelled(df.agg(counted.alias("Distinct_Raw_Count")), table, anomaly)


def distinct_values(df: DataFrame, column: str, collation: str = CASE_INSENSITIVE) -> DataFrame:
    """The different values of a raw text column in order, NULL first.

    Spellings which compare equal are one value, shown by the least of them.
    """
    return (
        df.groupBy(comparable(F.col(column), collation).alias(_LINK))
        .agg(F.min(column).alias(column))
        .select(column)
        .orderBy(F.col(column).asc_nulls_first())
    )


def orphan_count(
    child: DataFrame,
    fk: str,
    parent: DataFrame,
    pk: str,
    *,
    nullable: bool = False,
    collation: str | None = None,
    alias: str = "Affected_Row_Count",
) -> DataFrame:
    """How many child rows refer to no parent; a NULL counts only if not ``nullable``.

    The child is first reduced to one row per distinct reference. Those rows
    are already partitioned as the anti join needs them.
    """
    child_key, parent_key = F.col(fk), F.col(pk)
    if collation is not None:
        child_key, parent_key = comparable(child_key, collation), comparable(parent_key, collation)
    links = child.select(child_key.alias(_LINK))
    if nullable:
        links = links.where(F.col(_LINK).isNotNull())
    links = links.groupBy(_LINK).agg(F.count(F.lit(1)).alias(_ROWS))
    lost = links.join(parent.select(parent_key.alias(_LINK)), _LINK, "left_anti")
    return lost.agg(F.coalesce(F.sum(_ROWS), F.lit(0)).alias(alias))


def orphan_check(
    child: DataFrame, fk: str, parent: DataFrame, pk: str, table: str, anomaly: str, **options
) -> DataFrame:
    return _labelled(orphan_count(child, fk, parent, pk, **options), table, anomaly)
