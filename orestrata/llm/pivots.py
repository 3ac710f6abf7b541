"""Approximate nearest neighbours by a permutation index over pivots.

A vector is represented by the order of its distances to fixed pivots. Each shard of the
vectors has an inverted file per pivot: the place of that pivot in the order of each vector of the
shard. A query adds up, over the pivots' files, how far each vector's place is from its own
(Spearman's footrule), takes the share of each shard with the least sums, and reranks them by the
exact Euclidean distance in double precision. Queries are a stated set and are searched in blocks;
shards are the tasks' own chunks, so no vector is moved.

Pivots are a bounded sample (``PIVOTS`` vectors, by a hash of the id); every vector is indexed. Vectors which
are null, all zeros, or hold a null or a value that is not finite take no part, nor rows without an id, nor
vectors of another length than most have (ties: the shorter). Ties go to the smaller id, also where the share is cut.
Of rows repeated with an id, each is a candidate, and the least vector is the query. Extra columns are
not looked at. With an empty table, or no query, nothing is found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orestrata.sources.shared import settle

#: Pivots (at most 256, as places are bytes), vectors of a shard at most, queries of a block at most.
PIVOTS = 128
SHARD = 8192
QUERY_BLOCK = 1000
#: Share of a shard which is reranked, and the fewest.
RERANKED = 0.12
LEAST_RERANKED = 200


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): the vectors which take part, in double precision."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(finite & F.exists("v", lambda x: x != 0))
    size = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.where(F.size("v") == F.lit(size.size if size else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _places(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Place of each pivot (row) in the order of distances of each vector (column)."""
    distance = (pivots**2).sum(axis=1)[:, None] - 2 * pivots @ vectors.T
    order = np.argsort(distance, axis=0, kind="stable")
    places = np.empty(order.shape, dtype=np.uint8)
    np.put_along_axis(places, order, np.arange(len(pivots), dtype=np.uint8)[:, None], axis=0)
    return places


def choose_pivots(rows: DataFrame, count: int = PIVOTS) -> np.ndarray:
    """At most ``count`` distinct vectors: a bounded sample by a hash of the id."""
    chosen = rows.groupBy("v").agg(F.min("vec_id").alias("vec_id")).orderBy(F.xxhash64("vec_id")).limit(count)
    return np.array([r.v for r in chosen.collect()], dtype=np.float64)


def build_index(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Shards (ids, vectors, files): the inverted files are one row of places per pivot."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, SHARD):
                part = batch.slice(first, SHARD)
                vectors = _matrix(part.column("v"))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.column("vec_id").to_numpy().tobytes()], pa.binary()),
                        pa.array([vectors.tobytes()], pa.binary()),
                        pa.array([_places(vectors, pivots).tobytes()], pa.binary()),
                    ],
                    names=["ids", "vectors", "files"],
                )

    return settle(rows.mapInArrow(shards, "ids binary, vectors binary, files binary"))


def _block_search(index: DataFrame, queries: DataFrame, pivots: np.ndarray, k: int, share: float) -> DataFrame:
    """The k best of each shard for each query of one block."""
    table = queries.toArrow()
    ids = table["vec_id"].to_numpy()
    vectors = _matrix(table["v"].combine_chunks())
    shared = index.sparkSession.sparkContext.broadcast(
        (ids, vectors, _places(vectors, pivots).astype(np.int16).T if len(ids) else None)
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, query_vectors, query_places = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                own = np.frombuffer(row["ids"], dtype=np.int64)
                rows = np.frombuffer(row["vectors"], dtype=np.float64).reshape(len(own), -1)
                files = np.frombuffer(row["files"], dtype=np.uint8).reshape(-1, len(own)).astype(np.int16)
                found: list[tuple[np.ndarray, ...]] = []
                for query_id, query, places in zip(query_ids, query_vectors, query_places, strict=True):
                    footrule = np.abs(files - places[:, None]).sum(axis=0, dtype=np.int32)
                    most = min(len(own), max(LEAST_RERANKED, math.ceil(share * len(own))))
                    near = np.lexsort((own, footrule))[:most] if most < len(own) else np.arange(len(own))
                    near = near[own[near] != query_id]
                    score = np.sqrt(((rows[near] - query) ** 2).sum(axis=1))
                    best = np.lexsort((own[near], score))[:k]
                    found.append((np.full(len(best), query_id), own[near][best], score[best]))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x)) for x in zip(*found, strict=True)],
                        names=["query_id", "vec_id", "score"],
                    )

    return index.mapInArrow(search, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, share: float = RERANKED) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query among all other rows."""
    rows = usable(vectors)
    pivots = choose_pivots(rows)
    queries = settle(rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")))
    count = queries.count()
    blocks = max(1, math.ceil(count / QUERY_BLOCK))
    if not count:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = build_index(rows, pivots)
    parts = [
        _block_search(index, queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b), pivots, k, share)
        for b in range(blocks)
    ]
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
