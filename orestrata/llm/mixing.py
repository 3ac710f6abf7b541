"""Mixing sources to target weights by Poisson replication, in DataFrame expressions only.

Every source has a target share of the mixture and so a mean number of repetitions. Every
document draws its own number: a hash of its id under a seed is read as a uniform number and
put through the inverse of the Poisson distribution of that mean. Draws need no state, are
the same in every run, and expectation holds per source. Copies are then shuffled globally
by a second hash, range-partitioned, so that the order over all files is the mixture's.

A null text is carried as it is. A null source is a source of its own, named by null in
``weights``. A null id draws like an id of its own; rows repeated with the same id are
replicated alike. A source of weight 0 vanishes. Extra columns are carried; if one has the name of
a result, the result's gets underscores behind it (``result_names``). An empty table gives an empty mixture.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.llm.session import free_name
from orestrata.sources.shared import settle

SEED = "mixture-1"
#: 13 hexadecimal digits of a hash are exact in a double.
_SPAN = float(16**13)


def uniform(key: Column, salt: str) -> Column:
    """A number in [0, 1) which depends on key and salt only."""
    digits = F.substring(F.md5(F.concat(F.lit(salt + ":"), F.coalesce(key.cast("string"), F.lit("null")))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(_SPAN)


def repetitions(docs: DataFrame, weights: dict[str | None, float] | None = None) -> DataFrame:
    """(source, n, mean): rows of each source and its mean number of repetitions.

    Weights are shares of the mixture, which has as many documents as ``docs``; without
    them, all sources get equal shares. A source without a given weight gets none.
    """
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weight = F.lit(1.0)
    else:
        weight = F.lit(0.0)
        for source, value in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(source)), float(value)).otherwise(weight)
    counts = settle(counts.withColumn("weight", weight))
    total = counts.agg(F.sum("n").alias("n"), F.sum("weight").alias("weight")).first()
    scale = (total.n or 0) / total.weight if total.weight else 0.0
    return settle(counts.select("source", "n", (F.lit(scale) * F.col("weight") / F.col("n")).alias("mean")))


def poisson_draw(mean: Column, u: Column) -> Column:
    """The least k whose cumulative Poisson probability exceeds u.

    Steps through k with the running term and sum; beyond 10 deviations and 30 more from the
    mean no double below 1 is left. A mean over 700, whose first term would be nothing, is
    drawn in equal parts of at most 600 each, with u hashed anew for each part by the caller.
    """
    most = F.ceil(mean + 10 * F.sqrt(mean) + 30).cast("int")
    start = F.struct(
        F.exp(-mean).alias("term"), F.exp(-mean).alias("sum"), F.lit(0).alias("k"), F.lit(0).alias("at")
    )

    def step(state: Column, at: Column) -> Column:
        term = state["term"] * mean / at
        return F.struct(
            term.alias("term"),
            (state["sum"] + term).alias("sum"),
            F.when(state["sum"] <= u, at).otherwise(state["k"]).alias("k"),
            at.alias("at"),
        )

    return F.aggregate(F.sequence(F.lit(1), most), start, step, lambda state: state["k"])


def result_names(docs: DataFrame) -> tuple[str, str]:
    """What the mixture's own columns are called: copy and mix_key, unless ``docs`` has such."""
    return free_name("copy", docs.columns), free_name("mix_key", docs.columns)


def mixture(
    docs: DataFrame, weights: dict[str | None, float] | None = None, seed: str = SEED, partitions: int | None = None
) -> DataFrame:
    """All columns of ``docs`` plus copy (from 1) and mix_key, one row per replica, shuffled."""
    own_source, mean, times = (free_name(name, docs.columns) for name in ("__source", "__mean", "__count"))
    copy, mix_key = result_names(docs)
    means = repetitions(docs, weights).select(F.col("source").alias(own_source), F.col("mean").alias(mean))
    parts = F.greatest(F.lit(1), F.ceil(F.col(mean) / 600).cast("int"))
    draw = F.aggregate(
        F.sequence(F.lit(1), parts),
        F.lit(0),
        lambda total, part: total
        + poisson_draw(
            F.col(mean) / parts,
            uniform(F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), part.cast("string")), seed),
        ),
    )
    # The table of sources was written, so it is broadcast only if its files are small.
    drawn = (
        docs.join(means, docs["source"].eqNullSafe(means[own_source]))
        .withColumn(times, draw)
        .where(F.col(times) > 0)
        .withColumn(copy, F.explode(F.sequence(F.lit(1), times)))
        .withColumn(mix_key, F.md5(F.concat(F.lit(f"{seed}/order:"), F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col(copy).cast("string")))))
        .drop(own_source, mean, times)
    )
    count = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return drawn.repartitionByRange(count, mix_key).sortWithinPartitions(mix_key)


def oracle(seed: str = SEED) -> str:
    """The mixture of ``documents`` with equal shares as SQL; means stay below 600 there."""
    return f"""
    WITH RECURSIVE sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
    means AS (
      SELECT source, ((SELECT sum(n) FROM sizes)::DOUBLE / (SELECT count(*) FROM sizes)::DOUBLE) * 1.0 / n AS mean
      FROM sizes
    ),
    cdf AS (
      SELECT source, mean, 0 AS k, exp(-mean) AS term, exp(-mean) AS total FROM means
      UNION ALL
      SELECT source, mean, k + 1, term * mean / (k + 1), total + term * mean / (k + 1)
      FROM cdf WHERE k < ceil(mean + 10 * sqrt(mean) + 30)
    ),
    drawn AS (
      SELECT d.*, ('0x' || substr(md5('{seed}:' || d.doc_id || '/1'), 1, 13))::BIGINT::DOUBLE / {16**13}::DOUBLE AS u
      FROM documents d
    ),
    counted AS (
      SELECT r.doc_id, r.text, r.lang, r.source, r.n_chars,
             (SELECT count(*) FROM cdf c WHERE c.source = r.source AND c.total <= r.u) AS times
      FROM drawn r
    ),
    copies AS (
      SELECT doc_id, text, lang, source, n_chars, unnest(generate_series(1, times))::INT AS copy
      FROM counted WHERE times > 0
    )
    SELECT doc_id, text, lang, source, n_chars, copy, md5('{seed}/order:' || doc_id || '/' || copy) AS mix_key
    FROM copies
    """
