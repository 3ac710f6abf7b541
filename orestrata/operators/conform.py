"""Cleansing and typing of a raw table under its contract."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.functions.rules import Rule, carry
from orestrata.functions.stored_types import StoredType
from orestrata.operators.expectations import (
    FAIL,
    QUARANTINE,
    UNFIT,
    Enforced,
    Expectation,
    enforce,
    unique_rows,
    violation_report,
)

_UNIQUE = "_unique"
_COPY = "_copy"
_FITS = "_fits_"
_UNFIT_TYPE = "array<struct<Column:string,Value:string>>"


@dataclass(frozen=True)
class Field:
    name: str
    type: StoredType
    rule: Rule = carry
    required: bool = False


@dataclass(frozen=True)
class Check:
    name: str
    condition: Callable[[], Column]


@dataclass(frozen=True)
class Contract:
    """What a silver table promises: key, columns with their rules, checks.

    ``distinct`` says whether exact copies of a cleansed row are one row.
    """

    table: str
    key: str | tuple[str, ...]
    fields: tuple[Field, ...]
    distinct: bool = True
    checks: tuple[Check, ...] = field(default=())

    @property
    def keys(self) -> list[str]:
        """The columns of the key, which may be several."""
        return [self.key] if isinstance(self.key, str) else list(self.key)

    @property
    def columns(self) -> list[str]:
        return [each.name for each in self.fields]

    def retyped(self, **types: StoredType) -> Contract:
        """The same contract with other column types, e.g. 64-bit keys."""
        return replace(
            self,
            fields=tuple(
                replace(each, type=types.get(each.name, each.type)) for each in self.fields
            ),
        )


def cleanse(bronze: DataFrame, contract: Contract) -> DataFrame:
    """Apply the rules; source columns outside the contract are dropped."""
    return bronze.select(
        *[each.rule(F.col(f"`{each.name}`")).alias(each.name) for each in contract.fields]
    )


def store(cleansed: DataFrame, contract: Contract, *helpers: str) -> DataFrame:
    """Cast to the declared types, with a helper column per type that a value may not fit.

    Another one holds the name and text of each value which its type cannot hold.
    """
    outputs, unfit = [], []
    for each in contract.fields:
        value = F.col(f"`{each.name}`")
        outputs.append(each.type.store(value).alias(each.name))
        fits = each.type.fits(value, cleansed.schema[each.name].dataType)
        if fits is not None:
            outputs.append(fits.alias(_FITS + each.name))
            named = F.struct(F.lit(each.name).alias("Column"), value.cast("string").alias("Value"))
            unfit.append(F.when(~fits, named))
    unfit = F.array_compact(F.array(*unfit)) if unfit else F.array()
    return cleansed.select(*outputs, unfit.cast(_UNFIT_TYPE).alias(UNFIT), *helpers)


def type_expectations(stored: DataFrame, contract: Contract) -> list[Expectation]:
    """One per column; always met where the source's type leaves no other possibility."""
    return [
        Expectation(
            f"FIT_{contract.table}_{each.name}",
            F.col(_FITS + each.name) if _FITS + each.name in stored.columns else F.lit(True),
            lossy=each.type.max_length is None,
            certain=_FITS + each.name not in stored.columns,
        )
        for each in contract.fields
    ]


def required_expectations(contract: Contract) -> list[Expectation]:
    return [
        Expectation(f"NN_{contract.table}_{each.name}", F.col(f"`{each.name}`").isNotNull())
        for each in contract.fields
        if each.required
    ]


def check_expectations(contract: Contract) -> list[Expectation]:
    return [Expectation(check.name, check.condition()) for check in contract.checks]


def key_expectation(contract: Contract, unique: Column) -> Expectation:
    known = reduce(lambda a, b: a & b, [F.col(f"`{column}`").isNotNull() for column in contract.keys])
    return Expectation(f"PK_{contract.table}", known & unique)


def row_expectations(stored: DataFrame, contract: Contract) -> list[Expectation]:
    """All but that of the key: what a row meets or not by itself."""
    return [
        *type_expectations(stored, contract),
        *required_expectations(contract),
        *check_expectations(contract),
    ]


def conform(bronze: DataFrame, contract: Contract, policy: str = FAIL) -> Enforced:
    """Cleanse, type and check a raw table.

    Cleansing, typing and all row expectations are one narrow projection over
    the scan. Looking for repeated keys runs a job on the key column before
    the result is planned; if there are none, no row is exchanged.
    """
    rows = unique_rows(cleanse(bronze, contract), contract.keys, contract.distinct, _UNIQUE)
    stored = store(rows, contract, _UNIQUE)
    expectations = [key_expectation(contract, F.col(_UNIQUE)), *row_expectations(stored, contract)]
    return enforce(stored, expectations, policy, contract.table, contract.columns)


def violations(bronze: DataFrame, contract: Contract, prefix: str = "") -> DataFrame:
    """(TableName, ConstraintName, Violations) of the constraints whose names begin so.

    If that of the key is not asked for, no key is looked at: rows that violate none are
    filtered out by the scan's projection, and only the others are compared for copies.
    """
    if f"PK_{contract.table}".startswith(prefix):
        return conform(bronze, contract, QUARANTINE).only(prefix).report
    cleansed = cleanse(bronze, contract)
    if contract.distinct:
        cleansed = cleansed.withColumn(_COPY, F.struct(*[f"`{column}`" for column in contract.columns]))
    stored = store(cleansed, contract, *([_COPY] if contract.distinct else []))
    asked = [each for each in row_expectations(stored, contract) if each.name.startswith(prefix)]
    met = reduce(lambda a, b: a & b, [each.met for each in asked], F.lit(True))
    offending = stored.where(~met)
    if contract.distinct:
        offending = offending.dropDuplicates([_COPY])
    return violation_report(offending, contract.table, asked)

