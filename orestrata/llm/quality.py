"""Quality by hierarchical empirical Bayes: evidence of the document, its host and its path.

A classifier of the text alone (a logistic model of binned features, fitted on a bounded sample of labelled
rows) gives every document a probability of good quality. Sums of these per host and path, gathered
over all documents, give a rate for each site: a path's rate is shrunk to its host's and a host's to that
of all documents, by Beta priors whose weights come from the spread between the sites (method of moments), so a
site with few documents says little. A document's posterior odds are its own odds times those of its path against all.

Rows outside the held-out fold are labelled examples only; sites are described by predicted probabilities, so labels are no
input of a score but through the classifier. A null text is an empty one. A null host or path is a site of its own. Without labels
of both classes every document gets the smoothed rate. Rows repeated count as often as they occur. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.llm.text import WHITE_SPACE, bytes_of, chunks, of_each, word_hashes
from orestrata.sources.shared import settle

#: Labelled rows of the sample, and bins per feature.
SAMPLE = 20_000
BINS = 12
#: Bounds of the weight of a prior, in documents.
LEAST_WEIGHT, MOST_WEIGHT = 5.0, 10_000.0
#: No site moves the odds of a document by more than this factor.
SITE_FACTOR = 3.0
_TINY = 1e-4


def held_out(doc_id: Column, folds: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def features(texts: pa.Array) -> np.ndarray:
    """Form of each text: one row of numbers, from bytes and word hashes of the whole text."""
    data, bounds = bytes_of(texts)
    rows = len(texts)
    owner = of_each(bounds)

    def share(mask: np.ndarray) -> np.ndarray:
        return np.bincount(owner[mask], minlength=rows) / np.maximum(np.diff(bounds), 1)

    letters = ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A) | (data >= 0x80)
    upper = (data >= 0x41) & (data <= 0x5A)
    digits = (data >= 0x30) & (data <= 0x39)
    stops = np.isin(data, np.frombuffer(b".,;:?'\"", dtype=np.uint8))
    signs = ~letters & ~digits & ~stops & ~WHITE_SPACE[data]
    repeated = np.zeros(len(data), dtype=bool)
    repeated[1:] = signs[1:] & (data[1:] == data[:-1])
    words, cuts = word_hashes(texts)
    word_owner = of_each(cuts)
    counts = np.diff(cuts)
    order = np.lexsort((words, word_owner))
    sorted_words, sorted_owner = words[order], word_owner[order]
    new = np.ones(len(words), dtype=bool)
    new[1:] = (sorted_words[1:] != sorted_words[:-1]) | (sorted_owner[1:] != sorted_owner[:-1])
    again = np.zeros(len(words), dtype=bool)
    again[1:] = (words[1:] == words[:-1]) & (word_owner[1:] == word_owner[:-1])
    heads = np.flatnonzero(new)
    most = np.zeros(rows)
    np.maximum.at(most, sorted_owner[heads], np.diff(np.append(heads, len(words))))
    return np.stack(
        [
            np.log1p(np.diff(bounds)),
            share(letters),
            share(upper),
            share(digits),
            share(stops),
            share(signs),
            share(repeated),
            share(data == 0x7C),
            share(data == 0x0A),
            np.diff(bounds) / np.maximum(counts, 1),
            np.bincount(sorted_owner[new], minlength=rows) / np.maximum(counts, 1),
            np.bincount(word_owner[again], minlength=rows) / np.maximum(counts, 1),
            most / np.maximum(counts, 1),
        ],
        axis=1,
    )


@dataclass(frozen=True)
class Classifier:
    cuts: np.ndarray  # feature by inner bin edge
    weights: np.ndarray
    bias: float

    def probability(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_bins(features(texts), self.cuts) @ self.weights + self.bias, -30, 30)))


def _bins(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """One column per feature and bin, one where the value is in the bin."""
    out = np.zeros((len(values), cuts.shape[0] * (cuts.shape[1] + 1)))
    for k in range(cuts.shape[0]):
        at = np.searchsorted(cuts[k], values[:, k], side="right")
        out[np.arange(len(values)), k * (cuts.shape[1] + 1) + at] = 1.0
    return out


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, size: int = SAMPLE) -> Classifier:
    """The classifier of at most ``size`` labelled rows outside the held-out fold, by a hash of the id."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), folds))
        .orderBy(F.xxhash64("doc_id"), "quality")
        .limit(size)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in chunks(batch.column("text")):
                rows = features(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(part)),
                        batch.column("quality").slice(first, len(part)),
                        pa.array(list(rows), pa.list_(pa.float64())),
                    ],
                    names=["doc_id", "quality", "x"],
                )

    # At most ``size`` rows of two numbers, and then of a few numbers: bounded by the parameter.
    sample = texts.join(F.broadcast(chosen), "doc_id").mapInArrow(described, "doc_id long, quality int, x array<double>")
    rows = sample.orderBy("doc_id", "quality").toPandas()
    y = rows["quality"].to_numpy(dtype=float)
    width = features(pa.array([""])).shape[1]
    x = np.array(rows["x"].tolist(), dtype=float).reshape(len(rows), width)
    if len(np.unique(y)) < 2:
        rate = (y.sum() + 1) / (len(y) + 2)
        return Classifier(np.zeros((width, 0)), np.zeros(width), float(np.log(rate / (1 - rate))))
    cuts = np.quantile(x, np.arange(1, BINS) / BINS, axis=0).T
    weights, bias = _logistic(_bins(x, cuts), y)
    return Classifier(cuts, weights, bias)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3) -> tuple[np.ndarray, float]:
    """Newton steps of the penalised likelihood."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(penalty + 1e-9), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def _prior_weight(sites: DataFrame, total: Column, rate: Column) -> float:
    """Weight of the prior, in documents, from the spread of site rates around ``rate``.

    Method of moments over sites (n, good): the spread beyond what sites of such sizes have by chance.
    """
    row = sites.agg(
        F.sum(F.col("n")).alias("n"),
        F.count(F.lit(1)).alias("k"),
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - rate, 2)).alias("spread"),
        F.sum(rate * (1 - rate)).alias("chance"),
        F.sum(F.col("n") * rate * (1 - rate)).alias("inner"),
    ).first()
    if not row.n or row.k < 2:
        return LEAST_WEIGHT
    between = max(row.spread - row.chance, 0.0) / row.n
    inner = row.inner / row.n
    return float(np.clip(inner / between - 1 if between > 0 else MOST_WEIGHT, LEAST_WEIGHT, MOST_WEIGHT))


def site_rates(scored: DataFrame) -> tuple[DataFrame, float]:
    """(host, path, host_rate, path_rate) of every site, shrunk, and the rate of all documents."""
    paths = settle(
        scored.groupBy("host", "path").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("evidence").alias("good"))
    )
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    all_rows, all_good = paths.agg(F.sum("n"), F.sum("good")).first()
    rate = (all_good + 0.5) / (all_rows + 1) if all_rows else 0.5
    weight = _prior_weight(hosts, F.col("n"), F.lit(rate))
    hosts = settle(hosts.select("host", ((F.col("good") + weight * rate) / (F.col("n") + weight)).alias("host_rate")))
    own = hosts.select(F.col("host").alias("__host"), "host_rate")
    both = paths.join(own, F.col("host").eqNullSafe(F.col("__host"))).drop("__host")
    weight = _prior_weight(both, F.col("n"), F.col("host_rate"))
    shrunk = (F.col("good") + weight * F.col("host_rate")) / (F.col("n") + weight)
    return settle(both.select("host", "path", "host_rate", shrunk.alias("path_rate"))), float(rate)


def score(docs: DataFrame, classifier: Classifier, host: Column, path: Column) -> DataFrame:
    """doc_id, evidence, host_rate, path_rate, score and kept (a score of one half or more) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    @F.arrow_udf("double")
    def evidence(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            found = [shared.value.probability(part) for _, part in chunks(texts)]
            yield pa.array(np.concatenate(found) if found else np.zeros(0))

    scored = settle(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            host.cast("string").alias("host"),
            path.cast("string").alias("path"),
            evidence(F.col("text").cast("string")).alias("evidence"),
        )
    )
    sites, rate = site_rates(scored)
    sites = sites.select(F.col("host").alias("__host"), F.col("path").alias("__path"), "host_rate", "path_rate")

    def odds(p: Column) -> Column:
        p = F.least(F.greatest(p, F.lit(_TINY)), F.lit(1 - _TINY))
        return F.log(p / (1 - p))

    limit = float(np.log(SITE_FACTOR))
    shift = F.least(F.greatest(odds(F.col("path_rate")) - odds(F.lit(rate)), F.lit(-limit)), F.lit(limit))
    posterior = 1 / (1 + F.exp(-(odds(F.col("evidence")) + shift)))
    same = F.col("host").eqNullSafe(F.col("__host")) & F.col("path").eqNullSafe(F.col("__path"))
    return scored.join(sites, same).select(
        "doc_id", "evidence", "host_rate", "path_rate", posterior.alias("score"), (posterior >= 0.5).alias("kept")
    )
