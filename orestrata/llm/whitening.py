"""Whitening of embeddings onto their principal components, which FEAST finds.

Entries c become x = floor(64 c) + 1000000. Spark counts and sums the x-vectors, adds up the covariance of the
centred vectors (partial sums per task, added by an aggregation over matrix entries), and projects
every vector; only a matrix as wide as a vector has dimensions meets on the driver, where ``feast`` extracts
its greatest eigenpairs. All integer steps are exact: n * x - S is formed before anything is divided.

Vectors which are null, or hold a null or a value that is not finite, take no part, nor do vectors of another
length than most have (ties: the shorter) or of none. A vector of zeros takes part, equal ones as often as they
occur; a null id is carried. Components whose eigenvalue is nought to working precision cannot be
scaled to unit variance and are left out, so fewer than two different vectors give no rows, like an empty table. A
sum that does not fit 64 bits stops the job. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestrata.llm.feast import greatest_eigenpairs
from orestrata.sources.shared import settle

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
#: Rows whose components are written at once.
ROWS_OUT = 512
_LARGEST = 2.0**62


@dataclass(frozen=True)
class Whitening:
    """What was fitted: rows, sums per dimension, components (columns) with their eigenvalues, and the trace."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        if self.n * (float(np.abs(x).max(initial=0)) + 1) >= _LARGEST:
            raise OverflowError("n * x does not fit 64 bits")
        return self.n * x - self.sums

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n) @ self.vectors / np.sqrt(self.values)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): the vectors without a null or a value that is not finite, in double precision."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col("v").isNotNull() & (F.size("v") > 0)).where(finite)


def _integers(column: pa.Array) -> np.ndarray:
    """The x-vectors of equally long lists."""
    scaled = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False)) + SHIFT
    if np.abs(scaled).max(initial=0) >= _LARGEST:
        raise OverflowError("an entry does not fit 64 bits")
    return scaled.astype(np.int64).reshape(len(column), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length of a vector and task: (size, n, sums)."""
    counts: dict[int, int] = {}
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        column = batch.column("v")
        sizes = column.value_lengths().to_numpy(zero_copy_only=False)
        for size in np.unique(sizes).tolist():
            x = _integers(column.filter(pa.array(sizes == size)))
            counts[size] = counts.get(size, 0) + len(x)
            sums[size] = sums.get(size, 0) + x.sum(axis=0)
    yield pa.RecordBatch.from_pydict(
        {"size": list(counts), "n": list(counts.values()), "sums": [s.tolist() for s in sums.values()]},
        schema=pa.schema([("size", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]),
    )


def _added(partial: DataFrame, width: int) -> np.ndarray:
    """The sum of partial matrices given as rows (i, entries)."""
    entries = partial.select("i", F.posexplode("entries").alias("j", "entry"))
    total = np.zeros((width, width))
    for row in entries.groupBy("i", "j").agg(F.sum("entry").alias("entry")).collect():
        total[row.i, row.j] = row.entry
    return total


def _products(rows: DataFrame, width: int, left: Whitening, project: bool) -> np.ndarray:
    """The sum of y y' over all rows, y being the centred or the whitened vector."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            centred = left.centred(_integers(batch.column("v")))
            y = left.whitened(centred) if project else centred / left.n
            total += y.T @ y
        yield pa.RecordBatch.from_pydict(
            {"i": np.arange(width, dtype=np.int32), "entries": total.tolist()},
            schema=pa.schema([("i", pa.int32()), ("entries", pa.list_(pa.float64()))]),
        )

    return _added(rows.select("v").mapInArrow(partial, "i int, entries array<double>"), width)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, Whitening]:
    """The vectors which take part, and the whitening fitted on all of them."""
    rows = usable(vectors)
    sums = settle(rows.select("v").mapInArrow(_sums, "size int, n long, sums array<long>"))
    most = sums.groupBy("size").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "size").first()
    size, n = (most.size, most.n) if most else (0, 0)
    rows = rows.where(F.size("v") == F.lit(size))
    each = sums.where(F.col("size") == F.lit(size)).select(F.posexplode("sums").alias("i", "sum"))
    totals = np.zeros(size, dtype=np.int64)
    for row in each.groupBy("i").agg(F.sum("sum").alias("sum")).collect():
        totals[row.i] = row["sum"]
    unfitted = Whitening(n, totals, np.zeros(0), np.zeros((size, 0)), 0.0)
    if not size:
        return rows, unfitted
    covariance = _products(rows, size, unfitted, project=False) / n
    values, found = greatest_eigenpairs(covariance, components)
    known = values > 64 * size * np.finfo(np.float64).eps * values.max(initial=0)
    return rows, Whitening(n, totals, values[known], found[:, known], float(np.trace(covariance)))


def identity_error(rows: DataFrame, fitted: Whitening) -> float:
    """How far the covariance of the whitened vectors is from the identity, in its worst entry."""
    width = len(fitted.values)
    if not width:
        return 0.0
    return float(np.abs(_products(rows, width, fitted, project=True) / fitted.n - np.eye(width)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row per vector and component."""
    rows, fitted = fit(vectors, components)
    error, width = identity_error(rows, fitted), len(fitted.values)
    kind = rows.schema["vec_id"].dataType.simpleString()
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows if width else 0, ROWS_OUT):
                batch = whole.slice(first, ROWS_OUT)
                centred = fitted.centred(_integers(batch.column("v")))
                if (centred.astype(np.float64) ** 2).sum(axis=1).max(initial=0) >= _LARGEST:
                    raise OverflowError("a deviation does not fit 64 bits")
                deviation = (centred**2).sum(axis=1)
                count = batch.num_rows * width
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(np.repeat(np.arange(batch.num_rows), width))),
                        pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), batch.num_rows)),
                        pa.array(np.full(count, fitted.n, dtype=np.int64)),
                        pa.array(np.repeat(deviation, width)),
                        pa.array(fitted.whitened(centred).ravel()),
                        pa.array(np.tile(fitted.values / fitted.trace, batch.num_rows) if width else np.zeros(0)),
                        pa.array(np.full(count, error)),
                    ],
                    names=names,
                )

    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return rows.mapInArrow(out, schema)
