"""Declared constraints: what Parquet tables do not enforce by themselves.

A constraint is a condition each row must not contradict: as in SQL, a
condition that is unknown because of a NULL counts as met. Unique keys are
the one constraint which needs more than the row itself, see ``unique_rows``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from orestrata.sources.shared import settle, settle_counting

FAIL, QUARANTINE, WARN = "fail", "quarantine", "warn"
POLICIES = (FAIL, QUARANTINE, WARN)

FAILED = "FailedConstraints"
UNFIT = "UnfitValues"
VIOLATIONS = "TableName string, ConstraintName string, Violations bigint"

#: The column that says where a stored row belongs, and its values.
PART = "_part"
KEPT, REJECTED = "kept", "rejected"

_ROWS, _LISTED = "_rows", "_listed"


class ConstraintViolation(Exception):
    """Raised under the policy ``fail``; nothing of the table has been written."""


@dataclass(frozen=True)
class Expectation:
    """A named condition; ``lossy`` if a row that does not meet it has lost a value by its storing.

    ``certain`` if no row can fail to meet it.
    """

    name: str
    condition: Column
    lossy: bool = False
    certain: bool = False

    @property
    def met(self) -> Column:
        return F.coalesce(self.condition, F.lit(True))


def violation_report(df: DataFrame, table: str, expectations: Sequence[Expectation]) -> DataFrame:
    """(TableName, ConstraintName, Violations), one row per expectation, in one pass."""
    counts = [
        F.count_if(~expectation.met).alias(f"n{number}")
        for number, expectation in enumerate(expectations)
    ]
    rows = [
        F.struct(
            F.lit(table).alias("TableName"),
            F.lit(expectation.name).alias("ConstraintName"),
            F.col(f"n{number}").alias("Violations"),
        )
        for number, expectation in enumerate(expectations)
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


@dataclass(frozen=True)
class Enforced:
    """Rows with the expectations on them, split as a policy says.

    ``columns`` are those of the results; the rows may carry helper columns. Under ``warn`` a row
    stays whatever it violates, unless one of its values could not be stored: it would be NULL in the table.
    """

    table: str
    rows: DataFrame
    expectations: tuple[Expectation, ...]
    policy: str
    columns: tuple[str, ...]

    def _selected(self, df: DataFrame, *more: Column) -> DataFrame:
        return df.select(*[F.col(f"`{column}`") for column in self.columns], *more)

    def only(self, prefix: str) -> Enforced:
        """The same rows under the expectations whose names begin so; nothing is computed for the others."""
        chosen = [each for each in self.expectations if each.name.startswith(prefix)]
        return replace(self, expectations=tuple(chosen))

    def _all_met(self, lossy_only: bool = False) -> Column:
        asked = [each.met for each in self.expectations if each.lossy or not lossy_only]
        return reduce(lambda a, b: a & b, asked, F.lit(True))

    def _kept(self, df: DataFrame) -> DataFrame:
        return self._selected(df if self.policy == FAIL else df.where(self._all_met(self.policy == WARN)))

    @property
    def good(self) -> DataFrame:
        return self._kept(self.rows)

    @property
    def rejects(self) -> DataFrame:
        """Violating rows, with the values that could not be stored and the names of the failed constraints."""
        failed = F.array_compact(
            F.array(*[F.when(~each.met, F.lit(each.name)) for each in self.expectations])
        )
        unfit = [F.col(UNFIT)] if UNFIT in self.rows.columns else []
        return self._selected(self.rows.where(~self._all_met()), *unfit, failed.alias(FAILED))

    @property
    def report(self) -> DataFrame:
        return violation_report(self.rows, self.table, self.expectations)

    def laid_out(self) -> tuple[DataFrame, Observation]:
        """All rows to be stored in one pass, and what that pass will have counted.

        ``PART`` says whether a row is kept or rejected; under ``warn`` a row can be both, and is there twice. The
        rows carry the columns of the rejects, which are empty for kept ones. Under ``fail`` all are
        kept as they are. The observation has ``violations`` by the number of the
        expectation, and the rows of either part.
        """
        doubtful = {n: each for n, each in enumerate(self.expectations) if not each.certain}
        met = {f"_met{n}": each.met for n, each in doubtful.items()}
        unfit = [UNFIT] if UNFIT in self.rows.columns else []
        flagged = self.rows.select(
            *[f"`{column}`" for column in (*self.columns, *unfit)], *[test.alias(name) for name, test in met.items()]
        )
        all_met = reduce(lambda a, b: a & b, [F.col(name) for name in met], F.lit(True))
        stored = reduce(
            lambda a, b: a & b, [F.col(f"_met{n}") for n, each in doubtful.items() if each.lossy], F.lit(True)
        )
        kept = {FAIL: F.lit(True), QUARANTINE: all_met, WARN: stored}[self.policy]
        counts = [F.count_if(~F.col(f"_met{n}")).alias(f"violations{n}") for n in doubtful]
        seen = Observation()
        flagged = flagged.observe(
            seen, F.count_if(kept).alias(KEPT), F.count_if(~all_met).alias(REJECTED), *counts
        )
        if self.policy == FAIL:
            return self._selected(flagged), seen
        failed = F.array_compact(
            F.array(*[F.when(~F.col(f"_met{n}"), F.lit(each.name)) for n, each in doubtful.items()])
        ).cast("array<string>")
        part = F.when(all_met, F.lit(KEPT)).otherwise(F.lit(REJECTED))
        if self.policy == WARN:
            both = F.when(all_met, F.array(F.lit(KEPT))).otherwise(F.array(F.lit(REJECTED)))
            part = F.explode(F.when(~all_met & kept, F.array(F.lit(KEPT), F.lit(REJECTED))).otherwise(both))
        return self._selected(flagged, *unfit, failed.alias(FAILED), part.alias(PART)), seen

    def counted(self, seen: Observation) -> list[tuple[str, str, int]]:
        """The report from what a pass has counted: (table, constraint, violations)."""
        found = seen.get
        return [
            (self.table, each.name, found.get(f"violations{n}", 0)) for n, each in enumerate(self.expectations)
        ]


def enforce(
    df: DataFrame,
    expectations: Sequence[Expectation],
    policy: str = FAIL,
    table: str = "",
    columns: Sequence[str] | None = None,
) -> Enforced:
    """Apply row expectations.

    ``fail`` raises if any row violates one, ``quarantine`` splits the rows,
    ``warn`` keeps all rows as good (but those which lost a value) and lists the offending ones as well.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")
    result = Enforced(table, df, tuple(expectations), policy, tuple(columns or df.columns))
    if policy == FAIL:
        found = [f"{row[1]}: {row[2]}" for row in result.report.collect() if row[2]]
        if found:
            raise ConstraintViolation(f"{table} violates " + ", ".join(found))
    return result


def _key_known(key: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{column}`").isNotNull() for column in key])


def _repeated(df: DataFrame, key: Sequence[str]) -> tuple[DataFrame, int]:
    """The key values which occur more than once, settled, and their number.

    Reads the key columns only and exchanges one row per key value and task.
    """
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias(_ROWS))
    return settle_counting(counted.where(F.col(_ROWS) > 1).select(*key))


def repeated_keys(df: DataFrame, key: Sequence[str]) -> tuple[DataFrame, int]:
    """The non-NULL key values which occur more than once, settled, and their number."""
    return _repeated(df.select(*key).where(_key_known(key)), key)


def unique_rows(df: DataFrame, key: Sequence[str], distinct: bool, flag: str) -> DataFrame:
    """Make the key unique as far as that is possible without a choice.

    With ``distinct``, exact copies of a row collapse into one, those without a
    key included. Rows which still share their key are in conflict; a NULL
    shares nothing. The result is the rows with a boolean column ``flag``,
    false for conflicting rows.

    Only the key columns are shuffled: most tables turn out to have no
    repeated key, and then the rows pass without any exchange. Where keys do
    repeat, just the rows holding them are compared as a whole, once. Copies
    collapse within each task first, and are spread by all their columns.
    Where NULL repeats, such rows stay out of all joins by key.
    """
    listed, count = _repeated(df.select(*key), key)
    if not count:
        return df.withColumn(flag, F.lit(True))
    conflicts = listed.where(_key_known(key))
    nulls = listed.where(~_key_known(key)).count()
    keyed = df.where(_key_known(key)) if nulls else df
    if not distinct:
        marked = keyed.join(conflicts.withColumn(_LISTED, F.lit(True)), list(key), "left")
        marked = marked.withColumn(flag, F.col(_LISTED).isNull()).drop(_LISTED)
        return marked.unionByName(df.where(~_key_known(key)).withColumn(flag, F.lit(True))) if nulls else marked
    apart = keyed.join(conflicts, list(key), "left_anti").withColumn(flag, F.lit(True))
    copies = keyed.join(conflicts, list(key), "left_semi")
    if nulls:
        copies = copies.unionByName(df.where(~_key_known(key)))
    return apart.unionByName(unique_rows(settle(copies.dropDuplicates()), key, False, flag))
