"""Language-model scores under a hierarchical Pitman-Yor model of words, each word a context.

Every word has a class: each of the ``CLASSES`` most frequent tokens is a class of its own, all other
words, the rare ones, share ``GROUPS`` by their hash. Two levels of restaurants hang one beneath the other:

* a context per frequent token, and one for all rare words, whose dishes are the classes that follow. They share one
  parent, whose customers are their tables and whose base is uniform. Rare words are dishes of one more
  restaurant over a uniform base, with a dish in each group for words never seen there;
* beneath them a restaurant per rare word, whose dishes are all words that follow it, and one per frequent token and group,
  whose dishes are the group's words. Their base is what the level above gives the word. Frequent tokens after frequent
  ones are dishes above already. So every pair of words that occurs is seated, however rare, and each word has what follows it.

The probabilities of all words after any word sum to one. The upper level is fitted first, on all tokens, not on the tables beneath.

Seating is sampled by Gibbs sweeps: per dish, all its customers are lifted and seated again one after another given the
tables of the other dishes; behind the first ``SINGLY`` they are seated in blocks of a sixteenth of those seated. Predictive
probabilities are averaged over the samples after ``BURN_IN`` sweeps. All counts are over all rows outside the held-out fold.

The upper restaurants are groups of a Spark job, bounded by the classes. For the lower ones each task sends the pairs of words of
its rows to buckets, packed: by the context if it is rare, else by the word's group. A bucket holds its restaurants whole,
seats them and answers each row. A rare word makes up at most 1/1024 of the tokens, a group some 1/256 of the rare ones.

The ``HEAD`` most frequent words travel to every task with their counts; other words of a
document join the table of words before they go to a bucket. A null text is an empty one: the end token alone. Rows repeated are scored
each. A null id is held out. Extra columns are not looked at. An empty table gives no row, and without
training rows all words are unknown.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import chain, groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.llm.text import U64, chunks, find, mix, of_each, ragged, word_hashes
from orestrata.sources.shared import settle

CLASSES = 1023
GROUPS = 256
HEAD = 500_000
#: Tokens per bucket of rare contexts, and pairs a task holds before it sends them.
BUCKET, HELD = 1_500_000, 1_000_000
BURN_IN, SAMPLES = 2, 3
SINGLY = 48
#: Strengths, and the discount of the parent; other discounts come from counts of counts.
STRENGTH, PARENT_DISCOUNT = 1.0, 0.5
#: The end of a document, which is also the context of its first word.
END = np.uint64(0x5E9D)


def held_out(doc_id: Column, folds: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def _texts(docs: DataFrame, *others: Column) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *others)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each with its end, and where each text's begin."""
    words, bounds = word_hashes(texts)
    out = np.full(len(words) + len(texts), END, dtype=U64)
    out[np.arange(len(words)) + of_each(bounds)] = words
    return out, bounds + np.arange(len(bounds))


def word_counts(docs: DataFrame) -> DataFrame:
    """(h, c): every distinct token and its count, summed per task before the exchange."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, weight = np.zeros(0, U64), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.view(np.int64)), pa.array(weight)], names=["h", "c"])

        for batch in batches:
            for _, part in chunks(batch.column("text")):
                own, times = np.unique(tokens(part)[0], return_counts=True)
                both = np.concatenate([held, own])
                held, at = np.unique(both, return_inverse=True)
                weight = np.bincount(at, weights=np.concatenate([weight, times]), minlength=len(held)).astype(np.int64)
                if len(held) > 700_000:
                    yield out()
                    held, weight = np.zeros(0, U64), np.zeros(0, np.int64)
        yield out()

    return _texts(docs).select("text").mapInArrow(counted, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def seat(customers: np.ndarray, others: np.ndarray, base: np.ndarray, discount: float, draw: np.random.Generator) -> np.ndarray:
    """Tables of each dish when its customers sit down one after another.

    ``others``: tables of the other dishes in its restaurant; ``base``: the dish's probability in the parent.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    seated = 1
    live = np.flatnonzero(customers > 1)
    while len(live):
        step = 1 if seated < SINGLY else max(1, seated // 16)
        n = np.minimum(step, customers[live] - seated)
        new = (STRENGTH + discount * (others[live] + tables[live])) * base[live]
        chance = new / (new + seated - discount * tables[live])
        tables[live] += draw.binomial(n, chance) if step > 1 else draw.random(len(live)) < chance
        seated += step
        live = live[customers[live] > seated]
    return np.minimum(tables, customers)


def _discount(once: int, twice: int) -> float:
    """The usual estimate from counts of counts."""
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


@dataclass(frozen=True)
class Model:
    classes: np.ndarray  # sorted hashes of the frequent tokens
    steps: np.ndarray  # log10 P(class | context): frequent tokens, then groups; the last context is a rare word
    head: np.ndarray  # sorted hashes, their counts, and log10 P(word | rare)
    head_count: np.ndarray
    head_score: np.ndarray
    groups: np.ndarray  # log10 P(group | rare)
    unseen: float  # log10 P(unknown words of a group | rare)
    unknown: float  # log10 P(an unknown word | rare)
    total: int
    distinct: int
    docs: DataFrame | None  # training rows: read again for their pairs
    folds: int


def class_of(hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    at, there = find(classes, hashes)
    return np.where(there, at, len(classes))


def group_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes.view(U64) >> U64(40)).astype(np.int64) % GROUPS


def dish_of(hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The class as a dish: a frequent token, or the group of a rare word."""
    own = class_of(hashes, classes)
    return np.where(own < len(classes), own, len(classes) + group_of(hashes))


def pair_counts(docs: DataFrame, classes: np.ndarray) -> DataFrame:
    """(u, w, c): how often class w follows context u; at most one row per pair and task is moved."""
    contexts, size = len(classes) + 1, len(classes) + GROUPS
    end = int(class_of(np.array([END]), classes)[0])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(contexts * size, dtype=np.int64)
        for batch in batches:
            for _, part in chunks(batch.column("text")):
                own, bounds = tokens(part)
                now = dish_of(own, classes)
                before = np.minimum(_before(now, bounds, end), len(classes))
                seen += np.bincount(before * size + now, minlength=contexts * size)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array((at // size).astype(np.int32)), pa.array((at % size).astype(np.int32)), pa.array(seen[at])],
            names=["u", "w", "c"],
        )

    pairs = _texts(docs).select("text").mapInArrow(counted, "u int, w int, c long")
    return pairs.groupBy("u", "w").agg(F.sum("c").alias("c"))


def _before(now: np.ndarray, bounds: np.ndarray, end: int) -> np.ndarray:
    before = np.empty(len(now), dtype=np.int64)
    before[1:] = now[:-1]
    before[bounds[:-1]] = end
    return before


def _restaurant(sweep: int, parent: np.ndarray, discount: float):
    """One sweep over the dishes of one context."""

    def reseat(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("w")
        t, c = rows["t"].to_numpy(), rows["c"].to_numpy()
        draw = np.random.default_rng([sweep, int(rows["u"].iloc[0])])
        return rows.assign(t=seat(c, t.sum() - t, parent[rows["w"].to_numpy()], discount, draw))

    return reseat


def _predictive(parent: np.ndarray, discount: float):
    """Probabilities of all dishes in one context."""

    def probabilities(rows: pd.DataFrame) -> pd.DataFrame:
        c, t = rows["c"].to_numpy(dtype=float), rows["t"].to_numpy(dtype=float)
        p = (STRENGTH + discount * t.sum()) * parent
        p[rows["w"].to_numpy()] += c - discount * t
        return pd.DataFrame({"u": rows["u"].iloc[:1], "p": [(p / (STRENGTH + c.sum())).tobytes()]})

    return probabilities


def class_steps(pairs: DataFrame, contexts: int, size: int) -> np.ndarray:
    """log10 P(class | context), averaged over the samples; ``size`` numbers per context."""
    counts = pairs.agg(F.count_if(F.col("c") == 1).alias("once"), F.count_if(F.col("c") == 2).alias("twice")).first()
    discount = _discount(counts.once, counts.twice)
    state = settle(pairs.withColumn("t", F.lit(1).cast("long")))
    parent = np.full(size, 1.0 / size)
    total = np.zeros((contexts, size))
    for sweep in range(BURN_IN + SAMPLES):
        restaurant = _restaurant(sweep, parent, discount)
        state = settle(state.groupBy("u").applyInPandas(restaurant, "u int, w int, c long, t long"))
        # The parent has one dish per class: at most ``size`` rows.
        sums = state.groupBy("w").agg(F.sum("t").alias("t")).toPandas()
        customers = np.zeros(size, dtype=np.int64)
        customers[sums["w"]] = sums["t"]
        draw = np.random.default_rng([sweep, size])
        tables = np.minimum(customers, 1)
        for _ in range(3):
            tables = seat(customers, tables.sum() - tables, np.full(size, 1.0 / size), PARENT_DISCOUNT, draw)
        parent = (customers - PARENT_DISCOUNT * tables + (STRENGTH + PARENT_DISCOUNT * tables.sum()) / size) / (
            STRENGTH + customers.sum()
        )
        if sweep >= BURN_IN:
            # One row of ``size`` numbers per context; a context without customers is its parent.
            rows = state.groupBy("u").applyInPandas(_predictive(parent, discount), "u int, p binary").toPandas()
            met = np.zeros(contexts, dtype=bool)
            for u, p in zip(rows["u"], rows["p"], strict=True):
                total[u] += np.frombuffer(p)
                met[u] = True
            total[~met] += parent
    return np.log10(total / SAMPLES)


def _dishes(sweep: int, tables: int, base: float, discount: float):
    """One sweep over words of the last class; ``tables`` is the number of all their tables."""

    def reseat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = np.random.default_rng([sweep, TaskContext.get().partitionId()])
        for batch in batches:
            c, t = (batch.column(x).to_numpy() for x in ("c", "t"))
            t = seat(c, tables - t, np.full(len(c), base), discount, draw)
            yield pa.RecordBatch.from_arrays(
                [batch.column("h"), batch.column("c"), pa.array(t), batch.column("p")], names=["h", "c", "t", "p"]
            )

    return reseat


def word_scores(words: DataFrame, distinct: int) -> tuple[DataFrame, float]:
    """(h, c, score) of the words of the last class, log10 P(word | class), and that of an unknown word."""
    counts = words.agg(
        F.count_if(F.col("c") == 1).alias("once"),
        F.count_if(F.col("c") == 2).alias("twice"),
        F.count(F.lit(1)).alias("kinds"),
        F.coalesce(F.sum("c"), F.lit(0)).alias("all"),
    ).first()
    discount = _discount(counts.once, counts.twice)
    base = 1.0 / (distinct + 1)
    state = settle(words.select("h", "c", F.lit(1).cast("long").alias("t"), F.lit(0.0).alias("p")))
    tables, unknown = counts.kinds, 0.0
    for sweep in range(BURN_IN + SAMPLES):
        state = settle(state.mapInArrow(_dishes(sweep, tables, base, discount), "h long, c long, t long, p double"))
        tables = state.agg(F.coalesce(F.sum("t"), F.lit(0))).first()[0]
        if sweep >= BURN_IN:
            fresh = (STRENGTH + discount * tables) * base / (STRENGTH + counts["all"])
            unknown += fresh / SAMPLES
            own = (F.col("c") - discount * F.col("t")) / (STRENGTH + counts["all"]) + fresh
            state = state.withColumn("p", F.col("p") + own / SAMPLES)
    return settle(state.select("h", "c", F.log10("p").alias("score"))), float(np.log10(unknown))


def fit(docs: DataFrame, folds: int = 10) -> tuple[Model, DataFrame]:
    """The model of all rows outside the held-out fold, and its table of words (h, c, score)."""
    training = docs.where(~held_out(F.col("doc_id"), folds))
    words = settle(word_counts(training))
    total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    frequent = words.orderBy(F.desc("c"), "h").limit(CLASSES).toArrow()["h"].to_numpy().view(U64)
    classes = np.unique(np.append(frequent, END))
    steps = class_steps(settle(pair_counts(training, classes)), len(classes) + 1, len(classes) + GROUPS)
    # CLASSES + 1 rows of one number.
    marked = F.broadcast(docs.sparkSession.createDataFrame([(int(x),) for x in classes.view(np.int64)], "h long"))
    scored, unknown = word_scores(words.join(marked, "h", "left_anti"), distinct)
    # At most GROUPS rows; unknown words have what the known ones leave, the same in each group.
    group = F.shiftrightunsigned("h", 40) % GROUPS
    sums = scored.groupBy(group.alias("g")).agg(F.sum(F.pow(F.lit(10.0), "score")).alias("p"), F.count("h").alias("n")).toPandas()
    unseen = (distinct + 1 - int(sums["n"].sum())) * 10.0**unknown / GROUPS
    groups = np.full(GROUPS, unseen)
    groups[sums["g"].to_numpy(np.int64)] += sums["p"].to_numpy(float)
    table = scored.unionByName(words.join(marked, "h", "left_semi").withColumn("score", F.lit(0.0)))
    top = table.orderBy(F.desc("c"), "h").limit(HEAD).toArrow()
    hashes = top["h"].to_numpy().view(U64)
    order = np.argsort(hashes)
    model = Model(
        classes,
        steps,
        hashes[order],
        top["c"].to_numpy()[order],
        top["score"].to_numpy()[order],
        np.log10(groups),
        float(np.log10(unseen)),
        unknown,
        total,
        distinct,
        docs,
        folds,
    )
    return model, table


def _packed(columns: list[np.ndarray]) -> bytes:
    """Numbers of 8 bytes, the first of them rising; compressed byte by byte."""
    first, *others = columns
    rows = np.stack([np.diff(first, prepend=first.dtype.type(0)).view(np.int64), *(x.view(np.int64) for x in others)])
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(rows.view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpacked(data: bytes, columns: int) -> np.ndarray:
    found = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1).T
    rows = np.ascontiguousarray(found).view(np.int64).reshape(columns, -1)
    rows[0] = np.cumsum(rows[0])
    return rows


def _blobs(parts: list[list[np.ndarray]]) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed columns): the columns are bucket, restaurant, word and others."""
    bucket, restaurant, *others = (np.concatenate(x) for x in zip(*parts, strict=True))
    if not len(bucket):
        return
    order = np.lexsort((others[0], restaurant, bucket))
    bucket, restaurant, others = bucket[order], restaurant[order], [x[order] for x in others]
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    for first, last in zip(starts, np.append(starts[1:], len(bucket)), strict=True):
        yield int(bucket[first]), _packed([restaurant[first:last], *(x[first:last] for x in others)])


def _buckets(model: Model) -> int:
    return 1 + model.total // BUCKET


def _bucket(u: np.ndarray, w: np.ndarray, context: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each pair and its restaurant there. ``w``: hashes; ``u``: numbers of contexts; ``context``: their classes."""
    rare = context == len(model.classes)
    own = GROUPS + (mix(u.view(U64)) % U64(_buckets(model))).astype(np.int64)
    return np.where(rare, own, group_of(w)), np.where(rare, u, context)


def seated(
    bucket: int, restaurant: np.ndarray, word: np.ndarray, training: np.ndarray, base: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """log10 of each occurrence's probability over ``base``, in the order returned beside it.

    Occurrences of a word in a restaurant are its customers where ``training``; all restaurants are whole.
    """
    order = np.lexsort((word, restaurant))
    r, w = restaurant[order], word[order]
    opens = np.ones(len(r), dtype=bool)
    opens[1:] = r[1:] != r[:-1]
    new = opens.copy()
    new[1:] |= w[1:] != w[:-1]
    heads = np.flatnonzero(new)
    dish = np.cumsum(new) - 1
    house = (np.cumsum(opens) - 1)[heads]
    c = np.bincount(dish, weights=training[order], minlength=len(heads)).astype(np.int64)
    base = base[order][heads]
    guests = np.bincount(house, weights=c)
    discount = _discount(int((c == 1).sum()), int((c == 2).sum()))
    t, p = np.minimum(c, 1), np.zeros(len(c))
    many = np.flatnonzero(c > 1)
    for sweep in range(BURN_IN + SAMPLES):
        others = np.bincount(house, weights=t)[house[many]] - t[many]
        t[many] = seat(c[many], others, base[many], discount, np.random.default_rng([sweep, bucket]))
        if sweep >= BURN_IN:
            fresh = (STRENGTH + discount * np.bincount(house, weights=t)[house]) * base
            p += (c - discount * t + fresh) / (STRENGTH + guests[house]) / SAMPLES
    return np.log10(p / base)[dish], order


def _parts(docs: DataFrame, training: Column, model: Model, asked: bool, shared) -> DataFrame:
    """Two kinds of rows: those of ``docs`` with their sums over the upper level, and pairs packed for a bucket.

    Words outside the head stay in lists (h, u) beside their row. Pairs which are only learned from have a row below 0.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Model = shared.value
        size = len(known.classes)
        end = int(class_of(np.array([END]), known.classes)[0])
        end_number = int(_numbers(np.array([END]), known)[0][0])
        logs = np.log10(known.head_count + 0.1)
        row = TaskContext.get().partitionId() << 40 if asked else -(1 << 60)
        held: list[list[np.ndarray]] = []

        def sent() -> Iterator[pa.RecordBatch]:
            for bucket, pairs in _blobs(held) if held else ():
                nothing = [pa.nulls(1, field.type) for field in _PART if field.name not in ("bucket", "pairs")]
                yield pa.RecordBatch.from_arrays([*nothing, pa.array([bucket], pa.int32()), pa.array([pairs], pa.binary())], schema=_PART)
            held.clear()

        for batch in batches:
            learned = batch.column("training").to_numpy(zero_copy_only=False)
            for first, part in chunks(batch.column("text")):
                own, bounds = tokens(part)
                texts, owner = len(part), of_each(bounds)
                now = class_of(own, known.classes)
                before = _before(now, bounds, end)
                dish = np.where(now < size, now, size + group_of(own))
                value = known.steps[before, dish]
                number, there = _numbers(own, known)
                u = _before(number, bounds, end_number)
                at = np.where(there, number, 0)
                if len(known.head):
                    value += np.where(there & (now == size), known.head_score[at] - known.groups[group_of(own)], 0.0)
                base = np.where(there, logs[at], 0.0) if len(logs) else np.zeros(len(own))
                mine = learned[first : first + texts]
                pair = np.flatnonzero(there & ((now == size) | (before == size)))
                bucket, restaurant = _bucket(u[pair], own[pair], before[pair], known)
                held.append([bucket, restaurant, number[pair], (row + owner[pair]) * 2 + mine[owner[pair]]])
                rare = np.flatnonzero(~there)
                cuts = np.searchsorted(owner[rare], np.arange(texts + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + np.arange(texts, dtype=np.int64)),
                        batch.column("doc_id").slice(first, texts),
                        batch.column("training").slice(first, texts),
                        pa.array(np.diff(bounds)),
                        pa.array(np.bincount(owner, weights=there, minlength=texts).astype(np.int64)),
                        pa.array(np.bincount(owner, weights=base, minlength=texts)),
                        pa.array(np.bincount(owner, weights=value, minlength=texts)),
                        ragged(own[rare], cuts, pa.int64()),
                        ragged(u[rare], cuts, pa.int64()),
                        ragged(before[rare], cuts, pa.int64()),
                        pa.nulls(texts, pa.int32()),
                        pa.nulls(texts, pa.binary()),
                    ],
                    schema=_PART,
                )
                row += texts
                if sum(len(x[0]) for x in held) > HELD:
                    yield from sent()
        yield from sent()

    return _texts(docs, training.alias("training")).mapInArrow(
        scored,
        "row long, doc_id long, training boolean, n_tokens long, n_known long, base double, value double,"
        " h array<long>, u array<long>, context array<long>, bucket int, pairs binary",
    )


_LIST = pa.list_(pa.int64())
_PART = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("training", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64())]
    + [("base", pa.float64()), ("value", pa.float64()), ("h", _LIST), ("u", _LIST), ("context", _LIST)]
    + [("bucket", pa.int32()), ("pairs", pa.binary())]
)


def _numbers(hashes: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, its place in the head or else its hash below 0, and whether it is in the head."""
    at, there = find(model.head, hashes)
    return np.where(there, at, (hashes | U64(1 << 63)).view(np.int64)), there


def _rare_pairs(parts: DataFrame, words: DataFrame, shared) -> DataFrame:
    """(bucket, pairs) of words outside the head, which join the table of words for their counts and scores."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Model = shared.value
        held: list[list[np.ndarray]] = []

        def sent() -> Iterator[pa.RecordBatch]:
            for bucket, pairs in _blobs(held) if held else ():
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([pairs], pa.binary())], names=["bucket", "pairs"])
            held.clear()

        for batch in batches:
            row, u, h, context, c, score = (batch.column(x).to_numpy() for x in ("row", "u", "h", "context", "c", "score"))
            bucket, restaurant = _bucket(u, h.view(U64), context, known)
            held.append([bucket, restaurant, h, row, c, score])
            if sum(len(x[0]) for x in held) > HELD:
                yield from sent()
        yield from sent()

    each = (
        parts.where(F.col("bucket").isNull())
        .select((F.col("row") * 2 + F.col("training").cast("long")).alias("row"), F.explode(F.arrays_zip("h", "u", "context")).alias("word"))
        .select("row", "word.*")
        .join(words, "h", "left")
        .select("row", "u", "h", "context", F.coalesce("c", F.lit(0)).alias("c"), F.coalesce("score", F.lit(0.0)).alias("score"))
    )
    return each.mapInArrow(packed, "bucket int, pairs binary")


def _answers(bucket: int, blobs: list[tuple[bool, bytes]], model: Model) -> pa.RecordBatch:
    """(row, known, base, value): per row, what its words of this bucket add."""
    size = len(model.classes)
    head = [_unpacked(data, 3) for rare, data in blobs if not rare]
    tail = [_unpacked(data, 5) for rare, data in blobs if rare]
    near, far = (np.concatenate(x, axis=1) if x else np.zeros((n, 0), np.int64) for x, n in ((head, 3), (tail, 5)))
    hashes = np.concatenate([model.head[near[1]] if near.shape[1] else np.zeros(0, U64), far[1].view(U64)])
    restaurant, row = np.concatenate([near[0], far[0]]), np.concatenate([near[2], far[2]])
    count, score = far[3], np.where(far[3] > 0, far[4].view(np.float64), model.unseen)
    own = class_of(hashes, model.classes)
    group = group_of(hashes)
    above = np.concatenate([model.head_score[near[1]] if near.shape[1] else np.zeros(0), score]) - model.groups[group]
    above = np.where(own < size, 0.0, above)
    steps = model.steps[size][np.where(own < size, own, size + group)]
    base = 10.0 ** (above + steps if bucket >= GROUPS else above)
    gain, order = seated(bucket, restaurant, hashes, row % 2 == 1, base)
    value = np.empty(len(row))
    value[order] = gain
    outside = np.arange(len(row)) >= near.shape[1]
    value[outside] += above[outside]
    known, logs = np.zeros(len(row)), np.zeros(len(row))
    known[outside], logs[outside] = count > 0, np.log10(count + 0.1)
    asked = row >= 0
    rows, at = np.unique(row[asked] // 2, return_inverse=True)
    sums = [np.bincount(at, weights=x[asked], minlength=len(rows)) for x in (known, logs, value)]
    return pa.RecordBatch.from_arrays(
        [pa.array(rows), pa.array(sums[0].astype(np.int64)), *map(pa.array, sums[1:])],
        names=["row", "rare_known", "rare_base", "gain"],
    )


def score(docs: DataFrame, model: Model, words: DataFrame, folds: int = 10) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of every row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(replace(model, docs=None))
    training = ~held_out(F.col("doc_id"), model.folds)
    same = docs.sameSemantics(model.docs)
    parts = settle(_parts(docs, training if same else F.lit(False), model, True, shared))
    met = parts
    if not same:
        met = parts.unionByName(settle(_parts(model.docs.where(training), F.lit(True), model, False, shared)))

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Model = shared.value
        rows = chain.from_iterable(zip(*(batch.column(x).to_pylist() for x in ("bucket", "rare", "pairs")), strict=True) for batch in batches)
        for bucket, mine in groupby(rows, lambda x: x[0]):
            yield _answers(bucket, [x[1:] for x in mine], known)

    near = met.where(F.col("bucket").isNotNull()).select("bucket", F.lit(False).alias("rare"), "pairs")
    far = _rare_pairs(met, words, shared).select("bucket", F.lit(True).alias("rare"), "pairs")
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (GROUPS + _buckets(model)) // 4)
    lower = (
        near.unionByName(far)
        .repartition(count, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(answered, "row long, rare_known long, rare_base double, gain double")
        .groupBy("row")
        .agg(*(F.sum(x).alias(x) for x in ("rare_known", "rare_base", "gain")))
    )
    constant = float(np.log10(model.total + 0.1 * (model.distinct + 1)))
    value = F.col("value") + F.coalesce("gain", F.lit(0.0))
    rows = parts.where(F.col("bucket").isNull()).drop("h", "u", "context", "training", "bucket", "pairs")
    return rows.join(lower, "row", "left").select(
        "doc_id",
        held_out(F.col("doc_id"), folds).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n_tokens") * constant).alias("base_score"),
        value.alias("score"),
        F.pow(F.lit(10.0), -value / F.col("n_tokens")).alias("perplexity"),
    )
