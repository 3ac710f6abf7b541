"""Dense surrogate keys without a single-partition sort.

``row_number() over (order by key)`` moves the whole table into one task.
Here the keys are cut into ranges of equal width, the rows of each range are
counted, the counts are summed up over the ranges, and a row's number is the
sum before its range plus its rank within the range. As keys are unique, a
range never holds more rows than twice its width (the one around zero),
however the keys are spread. Keys of other types or of several columns have no
widths; their ranges are sampled, see ``ranks``. A NULL key is refused, as it has no rank.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orestrata.operators.ranks import row_numbers

WIDTH = 100_000
MOST_RANGES_IN_ONE_TASK = 1 << 17

_RANGE, _OUTER, _ROWS, _BEFORE, _BASE = "_range", "_outer", "_rows", "_before", "_base"
_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def _missing(key: Sequence[str]) -> Column:
    return F.raise_error(f"{', '.join(key)} is NULL: a row without a key cannot be numbered")


def surrogate_key(df: DataFrame, key: str | Sequence[str], name: str, width: int = WIDTH) -> DataFrame:
    """Append ``name``: the 1-based rank of each row by its unique key, of one or several columns.

    ``width`` is that of the ranges of an integer key. Under any other key the rows are settled.
    """
    columns = [key] if isinstance(key, str) else list(key)
    bits = _BITS.get(type(df.schema[columns[0]].dataType)) if len(columns) == 1 else None
    if bits is None:
        known = reduce(lambda a, b: a & b, [F.col(f"`{column}`").isNotNull() for column in columns])
        refused = F.when(known, F.lit(True)).otherwise(_missing(columns).cast("boolean"))
        return row_numbers(df.where(refused), columns, name)
    key = columns[0]
    most_ranges = (1 << bits) // width + 1
    missing = _missing(columns)
    known = F.when(F.col(key).isNull(), missing.cast("bigint")).otherwise(F.expr(f"`{key}` div {width}"))
    rows = df.withColumn(_RANGE, known)
    counts = rows.groupBy(_RANGE).agg(F.count(F.lit(1)).alias(_ROWS))
    before = _rows_before(counts, width, most_ranges)
    if most_ranges <= MOST_RANGES_IN_ONE_TASK:
        before = F.broadcast(before)  # bounded by the key's type, whatever the data
    rank = F.row_number().over(Window.partitionBy(_RANGE).orderBy(key))
    return (
        rows.join(before, _RANGE)
        .withColumn(name, F.col(_BEFORE) + rank)
        .drop(_RANGE, _BEFORE)
    )


def _rows_before(counts: DataFrame, width: int, most_ranges: int) -> DataFrame:
    """(_range, _before): the number of rows in all lower ranges.

    A running sum in one task if the key's type leaves few enough ranges.
    Otherwise (64-bit keys) a running sum within each range of ranges, on top
    of what lies before that, found in the same way.
    """
    if most_ranges <= MOST_RANGES_IN_ONE_TASK:
        running = Window.orderBy(_RANGE)
        base = F.lit(0).cast("bigint")
    else:
        counts = counts.withColumn(_OUTER, F.expr(f"{_RANGE} div {width}"))
        totals = counts.groupBy(F.col(_OUTER).alias(_RANGE)).agg(F.sum(_ROWS).alias(_ROWS))
        outer = _rows_before(totals, width, most_ranges // width + 1)
        counts = counts.join(outer.withColumnsRenamed({_RANGE: _OUTER, _BEFORE: _BASE}), _OUTER)
        running = Window.partitionBy(_OUTER).orderBy(_RANGE)
        base = F.col(_BASE)
    running = running.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = base + F.sum(_ROWS).over(running) - F.col(_ROWS)
    return counts.select(_RANGE, before.alias(_BEFORE))
