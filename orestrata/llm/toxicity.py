"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Fitting reads a bounded sample of labelled rows (``SAMPLE``, by a hash of the id). Its terms
(runs of letters, A-Z lower-cased) are the features if they tell the classes apart
(G-test); weights are (1 + log tf) * idf. Sample vectors which are equal are one
example with the number of its rows and of its toxic rows. Examples are cut into blocks of
similar vectors; each term has a list of blocks with its greatest weight there.

Queries are searched many at a time. A query sums these block maxima into bounds, scores the block of its highest
bound, and then each block whose bound is not below its k-th best cosine so far, so the neighbours are exact. Votes are
weighted by closeness and shrunk to the base rate; a monotone map fitted by leaving each
example out turns the share of votes into a probability. A text none of whose terms is a
feature gets the smoothed rate of such sample rows. Scores need the text only.

A null text is an empty one. Labels which are null are no labels; rows repeated in either
table count as often as they occur. With no labels all scores are the prior, 0.
Extra columns are not looked at. A null id is carried to the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.llm.session import releasing
from orestrata.llm.text import NOT_LETTERS, U64, chunks, find, of_each, word_hashes

#: Labelled rows of the sample, features, neighbours and examples per block.
SAMPLE = 20_000
FEATURES = 512
NEIGHBOURS = 15
BLOCK = 64
#: G statistic a feature must reach (one degree of freedom), and the rows it must occur in.
LEAST_G = 22.0
LEAST_ROWS = 4
_EPSILON = 0.05
#: Queries searched together.
AT_A_TIME = 1_000


def held_out(doc_id: Column, folds: int) -> Column:
    """Whether crc32 of the id as text leaves no remainder; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, folds: int, size: int = SAMPLE) -> DataFrame:
    """(doc_id, text, toxic) of at most ``size`` labelled rows outside the held-out fold."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), folds))
        .orderBy(F.xxhash64("doc_id"), "toxic")
        .limit(size)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # At most ``size`` rows of two numbers: bounded by the parameter.
    return texts.join(F.broadcast(chosen), "doc_id")


def _bags(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of each text: owner, term, count, sorted by owner and term."""
    words, bounds = word_hashes(texts, NOT_LETTERS)
    owner = of_each(bounds)
    order = np.lexsort((words, owner))
    words, owner = words[order], owner[order]
    new = np.ones(len(words), dtype=bool)
    new[1:] = (words[1:] != words[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return owner[at], words[at], np.diff(np.append(at, len(words)))


def term_counts(sample: DataFrame) -> DataFrame:
    """(term, rows, toxic_rows) over the sample, counted per task before the exchange."""

    @releasing
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in chunks(batch.column("text")):
                toxic = batch.column("toxic").slice(first, len(part)).to_numpy(zero_copy_only=False)
                owner, term, _ = _bags(part)
                unique, at = np.unique(term, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(unique.view(np.int64)),
                        pa.array(np.bincount(at, minlength=len(unique))),
                        pa.array(np.bincount(at, weights=toxic[owner], minlength=len(unique)).astype(np.int64)),
                    ],
                    names=["term", "rows", "toxic_rows"],
                )

    return (
        sample.mapInArrow(counted, "term long, rows long, toxic_rows long")
        .groupBy("term")
        .agg(F.sum("rows").alias("rows"), F.sum("toxic_rows").alias("toxic_rows"))
    )


def _discrimination(rows: int, toxic: int) -> Column:
    """G statistic of a term against the class, signed parts summed over the four cells."""
    n, t = F.col("rows").cast("double"), F.col("toxic_rows").cast("double")

    def cell(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    clean = F.lit(float(rows - toxic))
    all_rows, all_toxic = F.lit(float(rows)), F.lit(float(toxic))
    return 2 * (
        cell(t, n * all_toxic / all_rows)
        + cell(n - t, n * clean / all_rows)
        + cell(all_toxic - t, (all_rows - n) * all_toxic / all_rows)
        + cell(clean - (n - t), (all_rows - n) * clean / all_rows)
    )


@dataclass
class Index:
    """Features, examples in blocks, the block-max lists, and the calibration."""

    terms: np.ndarray  # sorted hashes
    idf: np.ndarray
    vectors: np.ndarray  # example by feature, unit length, float64; block after block
    ids: np.ndarray  # one sample id per example
    rows: np.ndarray
    toxic: np.ndarray
    maxima: np.ndarray  # block by feature
    prior: float
    empty: float
    knots: np.ndarray
    levels: np.ndarray

    def vector(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.terms))
        out[at] = (1 + np.log(counts)) * self.idf[at]
        return out / np.linalg.norm(out)

    def nearest_of(
        self, queries: np.ndarray, skip: np.ndarray | None = None
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """Places and cosines of the nearest examples of each query (row), exact; ties to the earlier example.

        ``skip`` names an example which a query must not find, or -1.
        """
        many = len(queries)
        skip = np.full(many, -1) if skip is None else skip
        bounds = queries @ self.maxima.T
        best = np.zeros((many, NEIGHBOURS))
        found = np.full((many, NEIGHBOURS), len(self.vectors))

        def meet(block: int, rows: np.ndarray) -> None:
            first = block * BLOCK
            cosines = queries[rows] @ self.vectors[first : first + BLOCK].T
            places = np.broadcast_to(first + np.arange(cosines.shape[1]), cosines.shape)
            cosines = np.where((cosines > 0) & (places != skip[rows, None]), cosines, 0.0)
            better = (cosines > 0) & (cosines >= best[rows, -1:])
            own = np.flatnonzero(better.any(axis=1))
            rows = rows[own]
            places = np.where(cosines[own] > 0, places[own], len(self.vectors))
            places, cosines = np.hstack([found[rows], places]), np.hstack([best[rows], cosines[own]])
            order = np.lexsort((places, -cosines))[:, :NEIGHBOURS]
            found[rows] = np.take_along_axis(places, order, axis=1)
            best[rows] = np.take_along_axis(cosines, order, axis=1)

        most = bounds.argmax(axis=1) if bounds.shape[1] else np.zeros(many, np.int64)
        for block in np.unique(most).tolist() if bounds.shape[1] else ():
            meet(block, np.flatnonzero(most == block))
        for block in np.argsort(-bounds.max(axis=0, initial=0.0), kind="stable").tolist():
            bound = bounds[:, block]
            rows = np.flatnonzero((bound > 0) & (bound >= best[:, -1] - 1e-12) & (most != block))
            if len(rows):
                meet(block, rows)
        return [(found[k][best[k] > 0], best[k][best[k] > 0]) for k in range(many)]

    def nearest(self, query: np.ndarray, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The same of one query."""
        return self.nearest_of(query[None, :], np.array([skip]))[0]

    def votes(self, places: np.ndarray, cosines: np.ndarray, less: tuple[int, int, int] = (-1, 0, 0)) -> float:
        """Share of toxic votes, closer examples counting more, shrunk to the prior."""
        closeness = 1.0 / (1.0 - np.minimum(cosines, 1.0) + _EPSILON)
        rows, toxic = self.rows[places].astype(float), self.toxic[places].astype(float)
        own = places == less[0]
        rows[own] -= less[1]
        toxic[own] -= less[2]
        # Many equal examples speak louder than one, but not in proportion.
        weight = closeness * np.log1p(rows)
        share = np.divide(toxic, rows, out=np.zeros_like(rows), where=rows > 0)
        return float((weight @ share + self.prior) / (weight.sum() + 1.0))

    def score(self, share: float) -> float:
        return float(np.interp(share, self.knots, self.levels))


def _monotone(shares: np.ndarray, toxic: np.ndarray, rows: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic map of shares to smoothed rates (pooled neighbours), by its knots."""
    order = np.argsort(shares, kind="stable")
    pools: list[list[float]] = []
    for share, t, n in zip(shares[order], toxic[order], rows[order], strict=True):
        pools.append([float(t), float(n), share * n, n])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [x + y for x, y in zip(pools[-1], last, strict=True)]
    if not pools:
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    at = np.array([p[2] / p[3] for p in pools])
    level = np.array([(p[0] + prior) / (p[1] + 1.0) for p in pools])
    return at, np.maximum.accumulate(level)


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5) -> Index:
    """The index of a bounded sample. It has at most ``SAMPLE`` examples of ``FEATURES`` terms."""
    sample = labelled_sample(docs, labels, folds)
    size, toxic_rows = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    prior = toxic_rows / size if size else 0.0
    chosen = (
        term_counts(sample)
        .where(F.col("rows") >= LEAST_ROWS)
        .withColumn("g", _discrimination(max(size, 1), toxic_rows))
        .where(F.col("g") >= LEAST_G)
        .orderBy(F.desc("g"), "term")
        .limit(FEATURES)
        .toPandas()
    )
    terms = chosen["term"].to_numpy(dtype=np.int64).view(U64)
    order = np.argsort(terms)
    terms = terms[order]
    idf = np.log((1 + size) / (1 + chosen["rows"].to_numpy(dtype=float)[order])) + 1

    @releasing
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in chunks(batch.column("text")):
                at, counts, bounds = _features(part, terms)
                cut = pa.array(bounds.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(part)),
                        batch.column("toxic").slice(first, len(part)),
                        pa.ListArray.from_arrays(cut, pa.array(at.astype(np.int32))),
                        pa.ListArray.from_arrays(cut, pa.array(counts.astype(np.int32))),
                    ],
                    names=["doc_id", "toxic", "at", "counts"],
                )

    examples = (
        sample.mapInArrow(features, "doc_id long, toxic int, at array<int>, counts array<int>")
        .groupBy("at", "counts")
        .agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("rows"), F.sum("toxic").alias("toxic"))
        .orderBy("at", "counts")
        .toPandas()
    )
    return _index(terms, idf, prior, examples)


def _features(texts: pa.Array, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each text: places in ``terms``, counts, and where each text's begin."""
    owner, words, counts = _bags(texts)
    at, there = find(terms, words)
    owner, at, counts = owner[there], at[there], counts[there]
    return at, counts, np.searchsorted(owner, np.arange(len(texts) + 1))


def _index(terms: np.ndarray, idf: np.ndarray, prior: float, examples) -> Index:
    zero = np.array([len(x) == 0 for x in examples["at"]], dtype=bool)
    rows, toxic = examples["rows"].to_numpy(dtype=np.int64), examples["toxic"].to_numpy(dtype=np.int64)
    empty = (toxic[zero].sum() + prior) / (rows[zero].sum() + 1.0)
    real = examples[~zero]
    index = Index(
        terms, idf, np.zeros((len(real), len(terms))), real["doc_id"].to_numpy(dtype=np.int64),
        rows[~zero], toxic[~zero], np.zeros((0, len(terms))), prior, float(empty), np.zeros(0), np.zeros(0),
    )
    for k, (at, counts) in enumerate(zip(real["at"], real["counts"], strict=True)):
        index.vectors[k] = index.vector(np.asarray(at), np.asarray(counts))
    if len(real):  # rows were ordered by their features, so neighbours in a block are alike
        index.maxima = np.maximum.reduceat(index.vectors, np.arange(0, len(real), BLOCK), axis=0)
    shares = []
    alone = np.where(index.rows == 1, np.arange(len(real)), -1)
    for first in range(0, len(real), AT_A_TIME):
        last = min(first + AT_A_TIME, len(real))
        near = index.nearest_of(index.vectors[first:last], alone[first:last])
        for k, (places, cosines) in zip(range(first, last), near, strict=True):
            shares.append(index.votes(places, cosines, (k, 1, index.toxic[k] / index.rows[k])))
    index.knots, index.levels = _monotone(np.array(shares), index.toxic, index.rows, prior)
    return index


Scored = tuple[float, list[int], list[float]]


def _scored(texts: pa.Array, index: Index, seen: dict[bytes, Scored], evidence: int) -> tuple[list[Scored], np.ndarray]:
    """Score and nearest examples of each text, and where each text's features begin.

    ``seen`` remembers the results of equal feature vectors.
    """
    at, counts, bounds = _features(texts, index.terms)
    if len(seen) >= 50_000:
        seen.clear()
    keys: list[bytes] = []
    new: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
    for k in range(len(texts)):
        own, often = at[bounds[k] : bounds[k + 1]], counts[bounds[k] : bounds[k + 1]]
        key = own.tobytes() + often.tobytes()
        keys.append(key)
        if key not in seen:
            new[key] = own, often
    known = [key for key, (own, _) in new.items() if len(own) and len(index.vectors)]
    seen |= dict.fromkeys(new, (index.empty, [], []))
    for first in range(0, len(known), AT_A_TIME):
        part = known[first : first + AT_A_TIME]
        near = index.nearest_of(np.stack([index.vector(*new[key]) for key in part]))
        for key, (places, cosines) in zip(part, near, strict=True):
            value = index.score(index.votes(places, cosines)) if len(places) else index.empty
            seen[key] = value, index.ids[places[:evidence]].tolist(), cosines[:evidence].tolist()
    return [seen[key] for key in keys], bounds


def score(docs: DataFrame, index: Index, evidence: int = 3) -> DataFrame:
    """doc_id, score, n_features and the nearest sample rows with their cosines, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    @releasing
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Index = shared.value
        seen: dict[bytes, Scored] = {}
        for batch in batches:
            for first, part in chunks(batch.column("text")):
                results, bounds = _scored(part, known, seen, evidence)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(part)),
                        pa.array([r[0] for r in results], pa.float64()),
                        pa.array(np.diff(bounds).astype(np.int32)),
                        pa.array([r[1] for r in results], pa.list_(pa.int64())),
                        pa.array([r[2] for r in results], pa.list_(pa.float64())),
                    ],
                    names=["doc_id", "score", "n_features", "nearest", "cosines"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        scored, "doc_id long, score double, n_features int, nearest array<long>, cosines array<double>"
    )


def drop_toxic(docs: DataFrame, index: Index, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score below the threshold, decided where they are read."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    @F.arrow_udf("boolean")
    @releasing
    def clean(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        seen: dict[bytes, Scored] = {}
        for texts in parts:
            kept = [r[0] < threshold for _, part in chunks(texts) for r in _scored(part, shared.value, seen, 0)[0]]
            yield pa.array(kept, pa.bool_())

    return docs.where(clean(F.col("text").cast("string")))
