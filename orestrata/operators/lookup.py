"""Joins along references."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PK, _SALT = "_pk", "_salt"

#: Partitions a heavy key is dealt to, as a multiple of all partitions.
_SALTS = 8
_MOST_SALTS = 4096


def optional_lookup(
    child: DataFrame, fk: str, parent: DataFrame, pk: str, spread_by: str
) -> DataFrame:
    """Left join of ``child`` to the row of ``parent`` which its reference names, if any.

    NULL references match nothing, yet a shuffle would send all of them to one
    task. They are spread by a hash of ``spread_by``, a key of the child,
    instead, which any type of reference can hold; the second condition keeps
    such a value from matching.
    """
    parent = parent.withColumnRenamed(pk, _PK)
    reference = F.col(fk)
    hashed = F.coalesce(reference, F.hash(spread_by).cast(child.schema[fk].dataType))
    matches = (hashed == F.col(_PK)) & reference.isNotNull()
    return child.join(parent, matches, "left").drop(_PK)


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def heavy_keys(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> dict[str, list]:
    """Per column the values that fill half a partition or more of a shuffle by it, all of them.

    One pass with a frequent-items sketch per column, whose size follows from the number of
    partitions; a second pass counts its candidates, so that none is named by mistake. At most twice as many
    values as partitions can be that frequent.
    """
    partitions = partitions or _partitions(df)
    most = 2 * partitions
    tracked = min(1 << 20, 8 * most)
    sketches = df.agg(
        *[F.expr(f"approx_top_k(`{column}`, {most}, {tracked})").alias(f"top{n}") for n, column in enumerate(columns)],
        F.count(F.lit(1)).alias("rows"),
    ).first()
    least = sketches["rows"] / most
    candidates = {
        column: [each["item"] for each in sketches[f"top{n}"] or () if each["item"] is not None and each["count"] >= least]
        for n, column in enumerate(columns)
    }
    if not any(candidates.values()):
        return candidates
    asked = [
        F.count_if(F.col(column) == F.lit(value)).alias(f"n{n}_{k}")
        for n, (column, values) in enumerate(candidates.items())
        for k, value in enumerate(values)
    ]
    counts = df.agg(*asked).first()
    return {
        column: [value for k, value in enumerate(values) if counts[f"n{n}_{k}"] >= least]
        for n, (column, values) in enumerate(candidates.items())
    }


def required_lookup(
    child: DataFrame, fk: str, parent: DataFrame, pk: str, heavy: Sequence = ()
) -> DataFrame:
    """Inner join of ``child`` to the row its reference names; others are lost.

    Rows which refer to a ``heavy`` key are dealt to many partitions by a salt, to each of which the key's
    one parent row is copied.
    """
    parent = parent.withColumnRenamed(pk, _PK)
    same = F.col(fk) == F.col(_PK)
    if not heavy:
        return child.join(parent, same).drop(_PK)
    salts = min(_MOST_SALTS, _SALTS * _partitions(child))
    own = F.when(F.col(fk).isin(*heavy), F.floor(F.rand(7) * salts).cast("int")).otherwise(F.lit(0))
    copies = F.when(F.col(_PK).isin(*heavy), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    parent = parent.withColumn(_SALT + _PK, F.explode(copies))
    salted = child.withColumn(_SALT, own)
    return salted.join(parent, same & (F.col(_SALT) == F.col(_SALT + _PK))).drop(_PK, _SALT, _SALT + _PK)


Heavy = Mapping[str, Sequence]
