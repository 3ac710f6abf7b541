"""Ranks by keys of any orderable types, of one column or several.

``rank() over (order by key)`` moves all rows into one task. Here Spark deals the rows into ranges
of the key, by splitters it samples, and sorts each range; a row's number is the sum of the
rows in lower ranges plus its place in its own. Rows of equal keys, however many, are spread over as many
ranges as they fill, and get the least of their numbers, as the rank wants it.

The number of ranges follows the rows, so that a range is sorted in memory whatever ``spark.sql.shuffle.partitions`` is.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.sources.shared import settle, settle_counting

_PLACE, _LEAST, _ROWS = "_place", "_least", "_rows"
#: Bits of the place in a range within ``monotonically_increasing_id``.
_PLACE_BITS = 33
_SEED = 17
#: Rows of a range; twice as many where there would be more than ``_UNBUFFERED`` ranges, to which a task writes
#: without holding its rows back.
RANGE_ROWS = 500_000
_UNBUFFERED = 200


def _columns(key: Sequence[str]) -> list[Column]:
    return [F.col(f"`{column}`") for column in key]


def _ranges(df: DataFrame, key: Sequence[str]) -> int:
    """As many ranges as the rows fill, and no fewer than a shuffle has partitions."""
    rows = df.select(*_columns(key)).count()
    filled = max(min(_UNBUFFERED, -(-rows // RANGE_ROWS)), -(-rows // (2 * RANGE_ROWS)))
    return max(filled, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def row_numbers(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """Append ``name``: the 1-based place of each row in the order of ``key``, NULL first, ties in any order.

    Dealing out the rows is one exchange; they are settled, so that a number stays with its row.
    """
    dealt = df.repartitionByRange(_ranges(df, key), *_columns(key), F.rand(_SEED)).sortWithinPartitions(*_columns(key))
    placed = settle(dealt.withColumn(_PLACE, F.monotonically_increasing_id()))
    own_range = F.shiftright(_PLACE, _PLACE_BITS)
    counts = placed.groupBy(own_range.alias("range")).agg(F.count(F.lit(1)).alias(_ROWS)).collect()
    rows = dict.fromkeys(range(1 + max((row.range for row in counts), default=0)), 0)
    rows |= {row.range: row[_ROWS] for row in counts}  # a number for each range
    before = F.from_json(F.lit(json.dumps([0, *accumulate(rows.values())])), "array<bigint>")
    place = F.col(_PLACE).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    number = F.get(before, own_range.cast("int")) + place + 1
    return placed.withColumn(name, number).drop(_PLACE)


def ranked(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """Append ``name``: SQL's rank of each row by ``key``. Equal keys, NULL included, have equal ranks."""
    numbered = row_numbers(df, key, name)
    shared = numbered.groupBy(*_columns(key)).agg(
        F.min(name).alias(_LEAST), F.count(F.lit(1)).alias(_ROWS)
    )
    ties, count = settle_counting(shared.where(F.col(_ROWS) > 1).drop(_ROWS))
    if not count:
        return numbered
    tied = [f"_tied{k}" for k in range(len(key))]
    ties = ties.toDF(*tied, _LEAST)
    same = [mine.eqNullSafe(F.col(theirs)) for mine, theirs in zip(_columns(key), tied)]
    rank = F.coalesce(_LEAST, name)
    return numbered.join(ties, same, "left").withColumn(name, rank).drop(*tied, _LEAST)
