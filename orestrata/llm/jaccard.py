"""N-gram Jaccard join: a blocked sparse product of documents by n-grams.

Each distinct set of word shingles is a row of a sparse incidence matrix, each shingle a
column; the product of the matrix with its transpose holds the overlaps. Links need an overlap
of at least ``num * (n + m) / (num + den)`` of two sets of n and m shingles, and these bounds,
which follow from the sizes alone, keep the product small without losing a link:

* one order of columns holds for all rows, common columns last. Two linked rows must share a
  column among the first ``n - ceil(num * n / den) + 1`` of each, and the rest behind
  a shared column must still be long enough on both sides. Only these entries are multiplied.
* each row carries a parity sketch, a power of two of bits and at least one per shingle; every shingle flips one. Two
  sketches differ in at most as many bits as the sets differ in shingles, so a pair whose sketches differ in
  more bits than its sizes allow is dropped. The longer of two sketches folds to the length of the shorter.
* what is left is counted exactly, on the whole rows. Pairs within a component that is known already are not
  formed: each row first tries one likely partner, so a group of near copies costs as many
  products as it has members, and only then the pairs between components.

The order of the columns decides only the cost, never the result. It comes from shingles which
are frequent in some input split, of all splits; the most frequent million are told apart.
Equal sets are one row of the matrix, so copies are never paired.

A null text counts as empty, an empty text has no shingles and no link. A text shorter than a shingle
is one shingle. Documents with a null id take part and get the component of their set, a null
component where no linked document has an id. Repeated rows are rows. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestrata.llm.components import components
from orestrata.llm.session import free_name, releasing
from orestrata.llm.text import U64, chunks, find, mix, of_each, ragged, shingles, word_hashes
from orestrata.sources.shared import settle, settle_counting

#: Shingles told apart by frequency in the order of columns, and how often a split must hold one.
ORDERED_SHINGLES = 1_000_000
SPLIT_FREQUENCY = 4
#: The longest list of candidate sets sent to every task, 8 bytes each.
BROADCAST_SETS = 2_000_000
#: The longest list of shared columns sent to every task, 8 bytes each; longer ones are joined.
BROADCAST_COLUMNS = 4_000_000
#: Fewest bits of a sketch, and the bits of its fold which goes along with every cell.
SKETCH_BITS = 1024
FOLD_BITS = 512

_SIGN = 1 << 63


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    return shingles(*word_hashes(texts), size)


def _frequent(docs: DataFrame, size: int) -> np.ndarray:
    """The most frequent shingles, most frequent last."""

    @releasing
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, weight = np.zeros(0, U64), np.zeros(0, np.int64)
        pending: list[np.ndarray] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            values = np.concatenate([held, *pending])
            weights = np.concatenate([weight, np.ones(len(values) - len(held), np.int64)])
            unique, at = np.unique(values, return_inverse=True)
            return unique, np.bincount(at, weights=weights, minlength=len(unique)).astype(np.int64)

        for batch in batches:
            for _, part in chunks(batch.column("text")):
                pending.append(_sets(part, size)[0])
                if sum(map(len, pending)) > 500_000:
                    held, weight = merged()
                    pending = []
                    if len(held) > 1_500_000:  # what was seen once so far makes room
                        held, weight = held[weight > 1], weight[weight > 1]
        held, weight = merged()
        often = weight >= SPLIT_FREQUENCY
        yield pa.RecordBatch.from_arrays(
            [pa.array(held[often].view(np.int64)), pa.array(weight[often])], names=["shingle", "n"]
        )

    found = (
        _texts(docs)
        .select("text")
        .mapInArrow(counted, "shingle long, n long")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "shingle")
        .limit(ORDERED_SHINGLES)
        .toArrow()
    )
    return found["shingle"].to_numpy().view(U64)[::-1]


def document_sets(docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """One row per row of ``docs``: doc_id, n, set_id, sketch, its fold, and prefix (its first columns)."""
    ranked = _frequent(docs, size)
    order = np.argsort(ranked)
    shared = docs.sparkSession.sparkContext.broadcast((ranked[order], order.astype(U64)))

    @releasing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = shared.value
        for batch in batches:
            for first, part in chunks(batch.column("text")):
                values, bounds = _sets(part, size)
                counts = np.diff(bounds)
                owner = of_each(bounds)
                at, there = find(known, values)
                place = values >> U64(1)
                place[there] = rank[at[there]] + U64(_SIGN)
                least = -(-counts * num // den)
                lengths = np.where(counts > 0, counts - least + 1, 0)
                sorted_at = np.lexsort((place, owner))
                nth = np.arange(len(values)) - bounds[owner]
                prefix = values[sorted_at][nth < lengths[owner]]
                ends = np.concatenate([[0], np.cumsum(lengths)])
                ids = np.zeros(len(counts), U64)
                np.add.at(ids, owner, mix(values + U64(11)))
                sketch, cuts = _sketches(values, owner, counts)
                fold = np.zeros((len(counts), FOLD_BITS // 64), np.int64)
                long_owner = of_each(cuts)
                at_fold = (np.arange(len(sketch)) - cuts[long_owner]) % (FOLD_BITS // 64)
                np.bitwise_xor.at(fold, (long_owner, at_fold), sketch)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(part)),
                        pa.array(counts.astype(np.int32)),
                        pa.array(mix(ids + counts.astype(U64)).view(np.int64)),
                        ragged(sketch, cuts, pa.int64()),
                        ragged(fold.ravel(), np.arange(len(counts) + 1) * (FOLD_BITS // 64), pa.int64()),
                        ragged(prefix, ends, pa.int64()),
                    ],
                    names=["doc_id", "n", "set_id", "sketch", "fold", "prefix"],
                )

    return _texts(docs).mapInArrow(
        rows, "doc_id long, n int, set_id long, sketch array<long>, fold array<long>, prefix array<long>"
    )


def _sketches(values: np.ndarray, owner: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity sketches as 64-bit words, one after the other, and where each begins."""
    bits = np.maximum(SKETCH_BITS, 1 << np.ceil(np.log2(np.maximum(counts, 1))).astype(np.int64))
    ends = np.concatenate([[0], np.cumsum(bits)])
    at = ends[owner] + (mix(values + U64(7)) & (bits[owner] - 1).astype(U64)).astype(np.int64)
    flipped = (np.bincount(at, minlength=ends[-1]) & 1).astype(np.uint8)
    return np.packbits(flipped, bitorder="little").view(np.int64), ends // 64


def _entries(classes: DataFrame) -> DataFrame:
    """Cells of the prefixes whose column has two rows at least: shingle, set_id, n, rest, and the fold f0, f1, ...

    ``rest`` counts the row's cells from this one on; the fold is the sketch folded to ``FOLD_BITS``.
    """
    fold = [F.col("fold")[k].alias(f"f{k}") for k in range(FOLD_BITS // 64)]
    cells = classes.select("set_id", "n", *fold, F.posexplode("prefix").alias("pos", "shingle")).select(
        "shingle", "set_id", "n", (F.col("n") - F.col("pos")).alias("rest"), *(f"f{k}" for k in range(FOLD_BITS // 64))
    )
    columns = classes.select(F.explode("prefix").alias("shingle")).groupBy("shingle").count().where("count > 1")
    columns, count = settle_counting(columns.select("shingle"))
    if count > BROADCAST_COLUMNS:
        return settle(cells.join(columns, "shingle", "left_semi"))
    shared = classes.sparkSession.sparkContext.broadcast(np.sort(columns.toArrow()["shingle"].to_numpy()))

    @F.arrow_udf("boolean")
    @releasing
    def met(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array(find(shared.value, part.to_numpy(zero_copy_only=False))[1])

    return settle(cells.where(met(F.col("shingle"))))


def _bounded(num: int, den: int) -> str:
    """What sizes, places and folded sketches of two cells of one column say against a link."""
    differ = " + ".join(f"bit_count(f{k}_a ^ f{k}_b)" for k in range(FOLD_BITS // 64))
    return (
        f"n_b * {num}L <= n_a * {den}L AND n_a * {num}L <= n_b * {den}L"
        f" AND least(rest_a, rest_b) * {num + den}L >= (n_a + n_b) * {num}L"
        f" AND {differ} <= n_a + n_b - 2 * {_need(num, den)}"
    )


def _need(num: int, den: int) -> str:
    """The overlap from which on two sets are linked."""
    return f"(((n_a + n_b) * {num}L + {num + den - 1}L) div {num + den}L)"


def _distinct_pairs(cells: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b, need, differ) of joined cells, once each, which the whole sketches do not rule out."""
    pairs = cells.groupBy(F.col("set_id_a").alias("a"), F.col("set_id_b").alias("b")).agg(
        F.first(F.expr(_need(num, den))).alias("need"), F.first(F.expr("n_a + n_b")).alias("total")
    )
    sketches = classes.select("set_id", "sketch")
    of_a = sketches.select(F.col("set_id").alias("a"), F.col("sketch").alias("sketch_a"))
    of_b = sketches.select(F.col("set_id").alias("b"), F.col("sketch").alias("sketch_b"))
    # Sizes of a pair differ by less than two times, and so do the lengths of its sketches.
    short = "least(size(sketch_a), size(sketch_b))"
    word = "if(size(sketch_{0}) = {1}, sketch_{0}[i], sketch_{0}[i] ^ sketch_{0}[i + {1}])"
    differ = (
        f"aggregate(sequence(0, {short} - 1), 0,"
        f" (sum, i) -> sum + bit_count({word.format('a', short)} ^ {word.format('b', short)}))"
    )
    met = pairs.join(of_a, "a").join(of_b, "b").withColumn("differ", F.expr(differ))
    return met.where("differ <= total - 2 * need").select("a", "b", "need", "differ")


def _named(cells: DataFrame, side: str) -> DataFrame:
    return cells.select(*(F.col(c).alias(f"{c}_{side}") for c in cells.columns))


def star_pairs(entries: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """For each set the likeliest link to the first set of one of its columns: at most one pair per set."""
    row = F.struct(F.col("rest"), *(c for c in entries.columns if c not in ("shingle", "rest")))
    first = entries.groupBy("shingle").agg(F.max(row).alias("row")).select("shingle", "row.*")
    cells = _named(entries, "a").join(
        _named(first, "b"), F.expr(f"shingle_a = shingle_b AND set_id_a <> set_id_b AND {_bounded(num, den)}")
    )
    pairs = _distinct_pairs(cells, classes, num, den)
    best = pairs.groupBy("a").agg(F.min(F.struct("differ", "b", "need")).alias("best"))
    return best.select("a", "best.b", "best.need")


def cross_pairs(entries: DataFrame, labels: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """All pairs (a, b, need) of sets in different components which the bounds do not rule out."""
    placed = settle(
        entries.join(labels.select(F.col("vertex").alias("set_id"), "component"), "set_id", "left").withColumn(
            "component", F.coalesce("component", "set_id")
        )
    )
    cells = _named(placed, "a").join(
        _named(placed, "b"),
        F.expr(f"shingle_a = shingle_b AND component_a <> component_b AND set_id_a < set_id_b AND {_bounded(num, den)}"),
    )
    return _distinct_pairs(cells, classes, num, den).select("a", "b", "need")


def _whole_sets(docs: DataFrame, size: int, wanted: DataFrame, count: int) -> DataFrame:
    """(set_id, shingles) of the wanted sets, each once."""
    shared = None
    if count <= BROADCAST_SETS:
        ids = wanted.toArrow()["set_id"].to_numpy()
        shared = docs.sparkSession.sparkContext.broadcast(np.sort(ids))

    @releasing
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in chunks(batch.column("text")):
                values, bounds = _sets(part, size)
                counts = np.diff(bounds)
                ids = np.zeros(len(counts), U64)
                np.add.at(ids, of_each(bounds), mix(values + U64(11)))
                ids = mix(ids + counts.astype(U64)).view(np.int64)
                keep = counts > 0 if shared is None else find(shared.value, ids)[1] & (counts > 0)
                keep &= np.isin(np.arange(len(ids)), np.unique(ids, return_index=True)[1])
                kept = keep[of_each(bounds)]
                ends = np.concatenate([[0], np.cumsum(counts[keep])])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[keep]), ragged(values[kept], ends, pa.int64())], names=["set_id", "shingles"]
                )

    found = _texts(docs).select("text").mapInArrow(rows, "set_id long, shingles array<long>")
    once = found.groupBy("set_id").agg(F.first("shingles").alias("shingles"))
    return once if shared else once.join(wanted, "set_id", "left_semi")


def linked(docs: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """Those of ``pairs`` (a, b, need) whose overlap, counted exactly, is ``need`` or more."""
    pairs = settle(pairs)
    ends = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    wanted, count = settle_counting(ends)
    whole = settle(_whole_sets(docs, size, wanted, count))
    of_a = whole.select(F.col("set_id").alias("a"), F.col("shingles").alias("shingles_a"))
    of_b = whole.select(F.col("set_id").alias("b"), F.col("shingles").alias("shingles_b"))
    return settle(
        pairs.join(of_a, "a")
        .join(of_b, "b")
        .where(F.size(F.array_intersect("shingles_a", "shingles_b")) >= F.col("need"))
        .select("a", "b")
    )


def set_components(docs: DataFrame, classes: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """(vertex, component) of all sets with a link.

    Stars first: every set tries one likely partner, which joins most of a group of near
    copies with as many pairs as it has members. Then every pair is tried which the
    bounds allow and whose sets are not in one component yet; nothing else could change the result.
    """
    entries = _entries(classes)
    stars = linked(docs, star_pairs(entries, classes, num, den), size)
    others = linked(docs, cross_pairs(entries, components(stars), classes, num, den), size)
    return components(stars.union(others))


def jaccard_components(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links, its own included).

    The similarity num / den is one half at least.
    """
    if not 0 < den <= 2 * num <= 2 * den:
        raise ValueError("the similarity of a link is between 1/2 and 1")
    sets = settle(document_sets(docs, size, num, den))
    classes = settle(
        sets.where("n > 0")
        .groupBy("set_id", "n")
        .agg(F.min("doc_id").alias("least_id"), *(F.first(c).alias(c) for c in ("sketch", "fold", "prefix")))
    )
    members = set_components(docs, classes, size, num, den).select(F.col("vertex").alias("set_id"), "component")
    named = settle(members.join(classes.select("set_id", "least_id"), "set_id"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    labels = settle(
        classes.select("set_id", "least_id")
        .join(named.join(least, "component").select("set_id", "component_id"), "set_id", "left")
        .select("set_id", F.coalesce("component_id", "least_id").alias("component_id"))
    )
    filled = sets.select("doc_id", "n", "set_id").where("n > 0").join(labels, "set_id")
    count = F.col("n").cast("long").alias("n_shingles")
    return filled.select("doc_id", count, "component_id").unionByName(
        sets.where("n = 0").select("doc_id", count, F.col("doc_id").alias("component_id"))
    )


def drop_near_duplicates(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` whose id is the least of their component, and those without an id.

    Rows repeated with one id share its fate: exact copies are the matter of exact dedup.
    """
    found = settle(jaccard_components(docs, size, num, den))
    name = free_name("__gone", docs.columns)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs["doc_id"] == F.col(name), "left_anti")
