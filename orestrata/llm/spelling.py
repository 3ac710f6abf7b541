"""Words grouped with their spelling variants: pairs one edit apart, found by k-d trees over letter counts.

Words are the runs of letters of all whole texts that are long and frequent enough. For each length a tree over a
bounded sample of the words cuts the space of letter counts into boxes; it only decides how evenly the work is
dealt. Every word belongs to one box, and is sent as a query to the boxes that one edit can reach: of those of its
own length to its own and later ones, as nearness is mutual, and to those of words a letter shorter. Within a box, a tree
over all its words prunes the range search, and the order of letters settles what the counts
leave open. So each pair is found, whatever the sample.
The words of a box are held by one task, queries stream past them.

A word's form is its most frequent near word if that is frequent enough; following forms ends at the root. As each
step multiplies the count, a few rounds of pointer doubling reach every root.

A null text has no words, an empty one neither; a null id counts as an empty text. Rows repeated
count as often as they occur. Of near words equally frequent the first in code-point order is the form. An empty
table has no words. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestrata.llm import kdtree
from orestrata.sources.shared import settle, settle_counting

#: Letters and occurrences of a word at least, and how many times as frequent a form is.
LEAST_LETTERS = 7
LEAST_COUNT = 2
FORM_FACTOR = 10
#: One run in so many loses a letter, by a checksum of the document's id and the run.
ALTERED = 31
#: Words in the sample which places the boxes (about), and words of a box (about).
SAMPLE = 65_536
BOX_WORDS = 4_000
#: Different words a task counts before it hands them on, and rows handed on at once.
HELD = 200_000
ROWS_OUT = 50_000
#: Queries a box gathers before it searches: many at a time spare calls.
ASKING = 30_000

_PLAIN = bytes(b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))
_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LETTERS)


def runs(doc_id: object, text: str | None) -> Iterator[tuple[str, int]]:
    """(word, occurrences): the text's long runs, some with a letter less."""
    plain = (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).decode("utf-8", "surrogatepass")
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, count in Counter(_RUN.findall(plain)).items():
        checksum = zlib.crc32(run.encode(), start)
        if checksum % ALTERED == 0:
            at = checksum % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= LEAST_LETTERS:
            yield run, count


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()

    def handed_on() -> Iterator[pa.RecordBatch]:
        words, counts = list(held), list(held.values())
        held.clear()
        for k in range(0, len(words), ROWS_OUT):
            columns = [pa.array(words[k : k + ROWS_OUT], pa.string()), pa.array(counts[k : k + ROWS_OUT], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
            for word, count in runs(doc_id.as_py(), text.as_py()):
                held[word] += count
        if len(held) > HELD:
            yield from handed_on()
    yield from handed_on()


def words(docs: DataFrame) -> tuple[DataFrame, int]:
    """(word, n) of all words that occur often enough, settled, and their number."""
    counted = docs.select("doc_id", "text").mapInArrow(_counted, "word string, n long")
    return settle_counting(counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT))


def boxes(known: DataFrame, count: int, sample: int = SAMPLE, box_words: int = BOX_WORDS) -> dict[int, kdtree.Tree]:
    """Per length of a word a tree whose leaves deal the words out, placed by a bounded sample."""
    every = max(1, -(-count // sample))
    rows = known.where(F.pmod(F.xxhash64("word"), F.lit(every)) == 0).select("word").collect()
    by_size: dict[int, list[str]] = {}
    for row in rows:
        by_size.setdefault(len(row.word), []).append(row.word)
    leaf = max(8, box_words // every)
    return {
        size: kdtree.Tree(kdtree.vectors(kdtree.codes(sorted(found))), leaf, tight=False)
        for size, found in by_size.items()
    }


#: Whether a row is a word of the box, or asks it: from within, so that both words of a pair do, or from elsewhere.
_OWN, _WITHIN, _ELSEWHERE = 0, 1, 2
_DEALT = "size int, box int, asks int, word string, n long"
_PAIRS = "word string, near string, near_n long"


def _by_size(found: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    sizes = np.array([len(word) for word in found])
    for size in np.unique(sizes).tolist():
        yield size, np.flatnonzero(sizes == size)


def _dealt(known: DataFrame, trees: dict[int, kdtree.Tree]) -> DataFrame:
    """Each word once in its own box, and as a query in every box that one edit can reach."""
    shared = known.sparkSession.sparkContext.broadcast(trees)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("word").to_pylist()
            for size, rows in _by_size(found):
                values = kdtree.vectors(kdtree.codes([found[k] for k in rows]))
                own, shorter = shared.value.get(size), shared.value.get(size - 1)
                homes = own.home(values) if own else np.zeros(len(rows), np.int64)
                parts = [(size, homes, np.full(len(rows), _OWN), rows)]
                everywhere = [(0, np.arange(len(rows)))]
                for box, asking in own.reached(values, kdtree.SAME_LENGTH) if own else everywhere:
                    asking = asking[homes[asking] <= box]
                    asks = np.where(homes[asking] == box, _WITHIN, _ELSEWHERE)
                    parts.append((size, np.full(len(asking), box), asks, rows[asking]))
                if size > LEAST_LETTERS:
                    for box, asking in shorter.reached(values, kdtree.ONE_SHORTER) if shorter else everywhere:
                        parts.append((size - 1, np.full(len(asking), box), np.full(len(asking), _ELSEWHERE), rows[asking]))
                order = pa.array(np.concatenate([part[3] for part in parts]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([np.full(len(part[3]), part[0], np.int32) for part in parts])),
                        pa.array(np.concatenate([part[1] for part in parts]).astype(np.int32)),
                        pa.array(np.concatenate([part[2] for part in parts]).astype(np.int32)),
                        batch.column("word").take(order),
                        batch.column("n").take(order),
                    ],
                    names=["size", "box", "asks", "word", "n"],
                )

    return known.mapInArrow(deal, _DEALT)


class _Box:
    """The words of a box, and queries until they are many enough for a search."""

    def __init__(self) -> None:
        self.words: list[str] = []
        self.counts: list[np.ndarray] = []
        self.tree: kdtree.Words | None = None
        self.asking: list[str] = []
        self.asking_counts: list[np.ndarray] = []
        self.asking_from: list[np.ndarray] = []

    def add(self, asks: int, found: list[str], counts: np.ndarray) -> None:
        if asks == _OWN:
            self.words += found
            self.counts.append(counts)
        elif self.words:
            self.asking += found
            self.asking_counts.append(counts)
            self.asking_from.append(np.full(len(found), asks))

    def search(self) -> Iterator[pa.RecordBatch]:
        if not self.asking:
            return
        if self.tree is None:
            self.tree, self.counts = kdtree.Words(self.words), [np.concatenate(self.counts)]
        counts, asks = np.concatenate(self.asking_counts), np.concatenate(self.asking_from)
        for size, rows in _by_size(self.asking):
            asked, at = self.tree.near([self.asking[k] for k in rows])
            asked = rows[asked]
            both = asks[asked] == _ELSEWHERE
            asker, own = pa.array(self.asking, pa.string()), pa.array(self.words, pa.string())
            for words, near, near_n in (
                (asker.take(pa.array(asked)), own.take(pa.array(at)), self.counts[0][at]),
                (own.take(pa.array(at[both])), asker.take(pa.array(asked[both])), counts[asked[both]]),
            ):
                yield pa.RecordBatch.from_arrays([words, near, pa.array(near_n)], names=["word", "near", "near_n"])
        self.asking, self.asking_counts, self.asking_from = [], [], []


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs one edit apart, from rows sorted by box, its own words first."""
    key, box = None, None
    for batch in batches:
        columns = [batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in ("size", "box", "asks")]
        keys = np.stack(columns)
        starts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)]) if batch.num_rows else []
        for first, last in zip(starts, [*starts[1:], batch.num_rows]):
            if key != (here := (int(keys[0, first]), int(keys[1, first]))):
                if box:
                    yield from box.search()
                key, box = here, _Box()
            part = batch.slice(first, last - first)
            box.add(int(keys[2, first]), part.column("word").to_pylist(), part.column("n").to_numpy())
            if len(box.asking) >= ASKING:
                yield from box.search()
    if box:
        yield from box.search()


def near_pairs(known: DataFrame, trees: dict[int, kdtree.Tree]) -> DataFrame:
    """(word, near, near_n): every pair one edit apart, in both directions."""
    dealt = _dealt(known, trees).repartition("size", "box").sortWithinPartitions("size", "box", "asks")
    return dealt.mapInArrow(_searched, _PAIRS)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: pointer doubling along (word, form)."""
    found, left = settle_counting(forms.select("word", F.col("form").alias("root")))
    while left:
        ends = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = found.join(ends, "root", "left")
        found = settle(jumped.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        left = found.where("moved").count()
        found = found.select("word", "root")
    return found


def variants(docs: DataFrame, sample: int = SAMPLE, box_words: int = BOX_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row per word."""
    known, count = words(docs)
    pairs = near_pairs(known, boxes(known, count, sample, box_words))
    best = pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    frequent = -F.col("best.less") >= FORM_FACTOR * F.col("n")
    described = settle(
        known.join(best, "word", "left").select(
            "word",
            F.when(frequent, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(frequent, -F.col("best.less")).alias("form_n"),
        )
    )
    ends = roots(described.where(F.col("form").isNotNull()))
    return described.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
