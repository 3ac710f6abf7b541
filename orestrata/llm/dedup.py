"""Exact dedup of whole texts against an immutable snapshot screened by binary-fuse filters.

Texts are equal if they are identical once every run of white space is one space. History
is a snapshot: exact buckets (one row per distinct text digest) and one static binary-fuse
filter per shard of the digests. A batch is first grouped by itself, so that its own copies
are one row however many they are, then screened by the filters: what a filter denies is
new for certain, and only the rest joins the exact buckets. Digests which occur more than
once are compared byte by byte; if texts of one digest differ, they are told apart.

Null texts count as empty. Rows repeated with the same id are copies: one of them stays. A
null id sorts behind all others. Other columns are not looked at. An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orestrata.llm import fuse
from orestrata.llm.text import find
from orestrata.llm.session import free_name
from orestrata.sources.shared import settle, settle_counting

#: Digests per filter, and the fewest shards, so that small snapshots are spread as well.
SHARD_KEYS = 100_000
LEAST_SHARDS = 256
#: The longest list of repeated digests sent to every task, 8 bytes each.
BROADCAST_KEYS = 4_000_000

Digest = Callable[[Column], Column]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _key(digests: pd.Series | pa.Array) -> np.ndarray:
    """The first eight bytes of each digest as a number."""
    heads = b"".join(bytes(x[:8]).ljust(8, b"\0") for x in digests)
    return np.frombuffer(heads, dtype="<u8").astype(np.uint64)


def _shard(digest: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(shards)).cast("int")


@dataclass(frozen=True)
class Snapshot:
    """Exact buckets (shard, digest, keep_id, copies) and filters (shard, image) of a history."""

    shards: int
    buckets: DataFrame
    filters: DataFrame

    @staticmethod
    def build(groups: DataFrame) -> Snapshot:
        """From one row per digest (digest, keep_id, copies)."""
        groups, count = settle_counting(groups)
        shards = max(LEAST_SHARDS, 1 << (count // SHARD_KEYS).bit_length())
        buckets = groups.withColumn("shard", _shard(F.col("digest"), shards))

        def image(rows: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"shard": rows["shard"].iloc[:1], "image": [fuse.build(_key(rows["digest"]))]})

        filters = settle(
            buckets.select("shard", "digest").groupBy("shard").applyInPandas(image, "shard int, image binary")
        )
        return Snapshot(shards, buckets, filters)

    def screen(self, groups: DataFrame) -> DataFrame:
        """``groups`` with ``maybe``: false where a filter proves the digest new."""

        def probe(_: tuple, rows: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            if len(rows):
                known = fuse.contains(filters["image"].iloc[0], _key(rows["digest"])) if len(filters) else False
                rows = rows.assign(maybe=known)
            else:
                rows = rows.assign(maybe=pd.Series(dtype=bool))
            return rows[["digest", "keep_id", "copies", "maybe"]]

        rows = groups.select("digest", "keep_id", "copies", _shard(F.col("digest"), self.shards).alias("shard"))
        return rows.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInPandas(
            probe, "digest binary, keep_id long, copies long, maybe boolean"
        )


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.sum("copies").alias("copies"))


def exact_duplicates(docs: DataFrame, digest: Digest = sha256) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, digest.

    The lower half of the id range is the history, the upper half the incoming batch.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("norm"))
    rows = settle(
        texts.select("doc_id", digest(F.col("norm")).alias("digest"))
        .groupBy("doc_id", "digest")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    bounds = rows.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    middle = 0 if bounds.low is None else (bounds.low + bounds.high) // 2
    is_old = F.coalesce(F.col("doc_id") <= F.lit(middle), F.lit(False))

    snapshot = Snapshot.build(_groups(rows.where(is_old)))
    batch = settle(snapshot.screen(_groups(rows.where(~is_old))))
    known = snapshot.buckets.select(
        "digest", F.col("keep_id").alias("old_id"), F.col("copies").alias("old_copies")
    )
    met = batch.where("maybe").join(known, "digest").select(
        "digest",
        F.least("keep_id", "old_id").alias("keep_id"),
        (F.col("copies") + F.col("old_copies")).alias("copies"),
    )
    alone = (
        snapshot.buckets.select("digest", "keep_id", "copies")
        .unionByName(batch.select("digest", "keep_id", "copies"))
        .where("copies > 1")
    )
    # A digest met in both halves sums up to more than either half has.
    repeated, count = settle_counting(
        met.unionByName(alone)
        .groupBy("digest")
        .agg(F.max_by(F.struct("keep_id", "copies"), "copies").alias("best"))
        .select("digest", "best.*")
    )
    equal, collided = _byte_checked(texts, digest, repeated, count)
    plain = rows.join(equal, "digest", "left").select("doc_id", "digest", "copies", "keep_id", "group_size")
    if collided is not None:
        apart = collided.select("digest").distinct()
        plain = plain.join(apart, "digest", "left_anti").unionByName(
            texts.select("doc_id", "norm", digest(F.col("norm")).alias("digest"))
            .groupBy("doc_id", "norm", "digest")
            .agg(F.count(F.lit(1)).alias("copies"))
            .join(collided, ["digest", "norm"])
            .select("doc_id", "digest", "copies", "keep_id", "group_size")
        )
    return plain.select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", "copies").alias("group_size"),
        "digest",
        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
    ).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "digest",
    )


def _byte_checked(
    texts: DataFrame, digest: Digest, repeated: DataFrame, count: int
) -> tuple[DataFrame, DataFrame | None]:
    """Groups whose texts are equal byte by byte (digest, keep_id, group_size), and those of
    digests shared by unequal texts, per text; the second is None if there are none, as ever
    with SHA-256. Only texts of repeated digests are moved, and copies meet in their own task.
    """
    candidates = texts.select("doc_id", "norm", digest(F.col("norm")).alias("digest"))
    if count <= BROADCAST_KEYS:
        candidates = candidates.where(_listed(repeated)(F.col("digest")))
    per_text = (
        candidates.groupBy("digest", "norm")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .join(repeated.select("digest"), "digest", "left_semi")
    )
    sizes = settle(
        per_text.groupBy("digest").agg(
            F.count(F.lit(1)).alias("texts"),
            F.first("keep_id").alias("keep_id"),
            F.first("group_size").alias("group_size"),
        )
    )
    equal = sizes.where("texts = 1").select("digest", "keep_id", "group_size")
    unequal = sizes.where("texts > 1").select("digest")
    if unequal.isEmpty():
        return equal, None
    return equal, per_text.join(unequal, "digest", "left_semi")


def _listed(repeated: DataFrame) -> Callable[[Column], Column]:
    """Whether a digest may be one of ``repeated``, by its first eight bytes."""
    rows = repeated.select(F.substring("digest", 1, 8).alias("head")).toArrow()["head"].to_pylist()
    keys = repeated.sparkSession.sparkContext.broadcast(np.unique(_key(rows)))

    @F.pandas_udf(T.BooleanType())
    def listed(digests: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in digests:
            yield pd.Series(find(keys.value, _key(part))[1])

    return listed


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` which stay, with all their columns.

    Of rows repeated with one id and text, columns aside, the one with the least JSON stays.
    """
    own, its_id, of = (free_name(name, docs.columns) for name in ("__digest", "__id", "__of"))
    marked = docs.withColumn(own, sha256(normalised(F.col("text"))))
    found = settle(exact_duplicates(docs))
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias(its_id), F.col("digest").alias(of)).distinct()
    twice = found.groupBy("doc_id", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.max("kept").alias("stays")
    ).where("n > 1 AND stays").select(F.col("doc_id").alias(its_id), F.col("digest").alias(of))
    same = marked["doc_id"].eqNullSafe(F.col(its_id)) & (marked[own] == F.col(of))
    kept = marked.join(gone, same, "left_anti").drop(own)
    if not twice.isEmpty():
        columns = [F.col(f"`{name}`") for name in docs.columns]
        once = (
            marked.join(twice, same, "left_semi")
            .groupBy("doc_id", own)
            .agg(F.min_by(F.struct(*columns), F.to_json(F.struct(*columns))).alias("row"))
        )
        kept = kept.unionByName(once.select("row.*"))
    return kept
