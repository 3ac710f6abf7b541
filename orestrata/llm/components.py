"""Connected components of an edge table by contraction, every step a join or an aggregate.

Each round hooks every vertex to its smallest neighbour, follows these pointers to their
ends, and replaces the edges by those between the ends. The number of vertices at least
halves per round. All tables are written to the shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestrata.sources.shared import settle, settle_counting


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) of every vertex of ``edges`` (a, b); the component is its least vertex."""
    edges, left = settle_counting(edges.select("a", "b").where("a <> b").distinct())
    labels = None
    while left or labels is None:
        pointers = _hooked(edges)
        if labels is None:
            labels = pointers.select("vertex", F.col("parent").alias("component"))
        else:
            ends = pointers.select(F.col("vertex").alias("component"), "parent")
            labels = settle(
                labels.join(ends, "component", "left").select(
                    "vertex", F.coalesce("parent", "component").alias("component")
                )
            )
        of_a = pointers.select(F.col("vertex").alias("a"), F.col("parent").alias("pa"))
        of_b = pointers.select(F.col("vertex").alias("b"), F.col("parent").alias("pb"))
        moved = edges.join(of_a, "a").join(of_b, "b").where("pa <> pb")
        edges, left = settle_counting(moved.select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct())
    return labels


def _hooked(edges: DataFrame) -> DataFrame:
    """(vertex, parent): the end of the chain of smallest neighbours which starts at the vertex."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pointers = settle(
        both.groupBy(F.col("a").alias("vertex")).agg(F.least("a", F.min("b")).alias("parent"))
    )
    while True:
        ends = pointers.select(F.col("vertex").alias("parent"), F.col("parent").alias("next"))
        jumped = pointers.join(ends, "parent").select("vertex", F.col("next").alias("parent"), (F.col("next") != F.col("parent")).alias("moved"))
        jumped, _ = settle_counting(jumped)
        if jumped.where("moved").isEmpty():
            return jumped.select("vertex", "parent")
        pointers = jumped.select("vertex", "parent")
