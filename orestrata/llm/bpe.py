"""BPE encoding through a table of distinct words, and decoding through the table of pieces.

Texts are split into words in Spark tasks (``Splitter``), distinct words are counted, and each
is encoded once. The table goes back to the words' positions in two ways, whose results are
the same: the most frequent words travel to every task, as many as leave one in ``REST``
occurrences to the others, and at most ``head`` (a parameter); the others join by word and then
by document and position, so that the rows of this join grow as the words of the texts do, at any
size. Between the two steps a document is its list of word numbers, compressed, beside its
other words. Decoding takes the piece of every id from the vocabulary, a table as small as the
tokenizer.

A null text counts as empty and has no tokens. Texts of any length are encoded whole. Rows
repeated with one id and text are returned as often as they occur; a null id is carried.
Extra columns are not looked at.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import cache
from hashlib import sha256
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestrata.llm.session import releasing
from orestrata.llm.text import chunks
from orestrata.sources.shared import settle

#: The most frequent words sent to every task, at most: some 20 MB, and 100 MB as the dictionary of a task.
HEAD = 500_000
#: One occurrence in so many is left to the join by word.
REST = 50
#: Words which occur as often or more are one class where the head is sized, so that there are no more classes.
CLASSES = 100_000
#: Words a task remembers before it starts anew.
REMEMBERED = 250_000
#: Words whose ids a worker keeps from one task to the next, some 100 MB.
KNOWN = 600_000

_ESCAPE = 0xFFFF
#: Characters which normalisation only lower-cases and which the classes below sort rightly.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-įı-ž]*")
_PLAIN_WORD = re.compile(
    r"'(?:s|t|re|ve|m|ll|d)|[a-zªµºß-öø-ÿā-ž]+|[0-9²³¹¼½¾]|[^\sa-zªµºß-öø-ÿā-ž0-9²³¹¼½¾]+"
)
#: The same for ASCII alone, where a class costs less.
_ASCII_WORD = re.compile(r"[a-z]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-z0-9]+", re.ASCII)
#: Words given to the tokenizer at a time.
_AT_A_TIME = 2_000


class Splitter:
    """Words of a text as the tokenizer's own normaliser and splitter find them."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        special = {t.content: n for n, t in self.whole.get_added_tokens_decoder().items() if t.special}
        self.special = {name: [number] for name, number in special.items()}
        self._parts = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
        self._words = Tokenizer(self.whole.model)
        self._words.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        alphabet = _byte_letters()
        self._bytes = {letter: byte for byte, letter in alphabet.items()}

    def split(self, text: str) -> list[str]:
        if "<|" not in text:
            return self._plain(text)
        words: list[str] = []
        for part in self._parts.split(text):
            if part in self.special:
                words.append(part)
            elif part:
                # A string that looks like a special token after lower-casing is none: mark it.
                words += ["\0" + w if w in self.special else w for w in self._plain(part)]
        return words

    def _plain(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text):
            return (_ASCII_WORD if text.isascii() else _PLAIN_WORD).findall(text.lower())
        pieces = self.whole.pre_tokenizer.pre_tokenize_str(self.whole.normalizer.normalize_str(text))
        return [bytes(map(self._bytes.__getitem__, piece)).decode("utf-8", "surrogateescape") for piece, _ in pieces]

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and where each word's begin, the end last."""
        plain = ["" if w in self.special else w[1:] if w[0] == "\0" and w[1:] in self.special else w for w in words]
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]
        for first in range(0, len(plain), _AT_A_TIME):
            part = plain[first : first + _AT_A_TIME]
            found = self._words.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(found.ids, dtype=np.uint32))
            counts.append(np.bincount(np.array(found.word_ids, dtype=np.int64), minlength=len(part)))
        bounds = np.cumsum(np.concatenate(counts))
        own = [k for k, w in enumerate(words) if w in self.special]
        numbers = [self.special[words[k]][0] for k in own]
        whole = np.insert(np.concatenate(ids), bounds[own], numbers)
        return whole, bounds + np.searchsorted(own, np.arange(len(bounds)))

    def pieces(self) -> list[str]:
        """The piece of each id."""
        return [self.whole.id_to_token(k) or "" for k in range(self.whole.get_vocab_size())]


def _byte_letters() -> dict[int, str]:
    """The printable letter which stands for each byte in byte-level pieces."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


@cache
def splitter(path: str) -> Splitter:
    """One per worker process."""
    return Splitter(path)


class _Numbers(dict):
    """A number for each word, in the order met; ``new`` are those not encoded yet."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class Encoder:
    """Ids of whole texts: a word is encoded when a worker first meets it, some ``KNOWN`` are kept."""

    def __init__(self, path: str) -> None:
        self._splitter = splitter(path)
        self._forget()

    def _forget(self) -> None:
        self._number = _Numbers()
        self._ids, self._bounds = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and where each text's begin, the end last."""
        if len(self._number) > KNOWN:
            self._forget()
        split, number = self._splitter.split, self._number
        words = [split(text or "") for text in texts]
        counts = np.array([0, *map(len, words)], dtype=np.int64)
        numbers = np.fromiter(map(number.__getitem__, chain.from_iterable(words)), np.int64, int(counts.sum()))
        if number.new:
            ids, bounds = self._splitter.encode(number.new)
            number.new = []
            self._bounds = np.concatenate([self._bounds, self._bounds[-1] + bounds[1:]])
            self._ids = np.concatenate([self._ids, ids])
        ends = np.concatenate([[0], np.cumsum(np.diff(self._bounds)[numbers])])
        return _gather(self._ids, self._bounds, numbers), ends[np.cumsum(counts)]


@cache
def encoder(path: str) -> Encoder:
    """One per worker process."""
    return Encoder(path)


def word_table(docs: DataFrame, path: str) -> DataFrame:
    """(word, n, ids): every distinct word of the texts, its occurrences, its ids (2 bytes each)."""

    @releasing
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter(path).split
        seen: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            for text in batch.column("text"):
                for word in split(text.as_py() or ""):
                    seen[word] = seen.get(word, 0) + 1
                if len(seen) > REMEMBERED:
                    yield out()
                    seen.clear()
        yield out()

    @releasing
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = splitter(path).encode
        for batch in batches:
            found, bounds = encode(batch.column("word").to_pylist())
            packed, cuts = found.astype("<u4").tobytes(), (4 * bounds).tolist()
            ids = [packed[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), pa.array(ids, pa.binary())], names=["word", "n", "ids"]
            )

    words = (
        docs.select(F.col("text").cast("string").alias("text"))
        .mapInArrow(counted, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )
    return settle(words.mapInArrow(encoded, "word string, n long, ids binary"))


def head_size(words: DataFrame, most: int, rest: int = REST) -> tuple[int, int]:
    """How many of the most frequent words leave one in ``rest`` occurrences, ``most`` at most, and the least n among them."""
    own = words.groupBy(F.least("n", F.lit(CLASSES)).alias("n"))
    classes = own.agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("total")).collect()
    total = sum(row.total for row in classes)
    size, least, left = 0, CLASSES, total - total // rest
    for row in sorted(classes, reverse=True):
        if left <= 0 or size >= most:
            break
        needed = row.words if row.n == CLASSES else min(row.words, -(-left // row.n))
        size, least, left = min(most, size + needed), row.n, left - row.total
    return size, least


class Head:
    """The most frequent words: number by word, their ids in one ragged array, the least n of one (None without any)."""

    def __init__(self, words: DataFrame, size: int) -> None:
        size, least = head_size(words, size)
        frequent = words.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(size)
        rows = frequent.select("word", "n", "ids").toArrow()
        self.words = rows["word"].to_pylist()
        self.least = pc.min(rows["n"]).as_py()
        self.ids, self.bounds = _joined(rows["ids"].to_pylist())


def _joined(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
    return np.frombuffer(b"".join(packed), dtype="<u4"), np.concatenate([[0], np.cumsum(lengths)])


def _gather(ids: np.ndarray, bounds: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The ids of the numbered words, one after the other."""
    lengths = np.diff(bounds)[numbers]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return ids[np.arange(total) + np.repeat(bounds[numbers] - (ends - lengths), lengths)]


_COMPRESS = zstandard.ZstdCompressor(level=3)
_EXPAND = zstandard.ZstdDecompressor()


def _packed_numbers(numbers: np.ndarray) -> bytes:
    """Two bytes for common words, and four more behind the list for the others."""
    short = np.minimum(numbers, _ESCAPE).astype("<u2")
    return _COMPRESS.compress(short.tobytes() + numbers[numbers >= _ESCAPE].astype("<u4").tobytes())


def _unpacked_numbers(data: bytes, count: int) -> np.ndarray:
    raw = _EXPAND.decompress(data)
    numbers = np.frombuffer(raw, dtype="<u2", count=count).astype(np.int64)
    numbers[numbers == _ESCAPE] = np.frombuffer(raw, dtype="<u4", offset=2 * count)
    return numbers


def _packed_words(words: list[str]) -> bytes:
    """The words' lengths and the words."""
    if not words:
        return b""
    sizes = np.array([len(words), *map(len, words)], dtype="<u4")
    return _COMPRESS.compress(sizes.tobytes() + "".join(words).encode())


def _unpacked_words(data: bytes) -> list[str]:
    if not data:
        return []
    raw = _EXPAND.decompress(data)
    count = int(np.frombuffer(raw, dtype="<u4", count=1)[0])
    ends = np.cumsum(np.frombuffer(raw, dtype="<u4", count=count, offset=4)).tolist()
    text = raw[4 * count + 4 :].decode()
    return [text[a:b] for a, b in pairwise([0, *ends])]


def encode(docs: DataFrame, path: str, head: int = HEAD) -> DataFrame:
    """doc_id and ids (binary, 4 bytes each, little-endian) of every row of ``docs``."""
    words = word_table(docs, path)
    frequent = Head(words, head)
    others = words if frequent.least is None else words.where(F.col("n") <= frequent.least)
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    @releasing
    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter(path).split
        known: Head = shared.value
        number = {word: k for k, word in enumerate(known.words)}
        other = len(number)
        for batch in batches:
            for first, part in chunks(batch.column("text")):
                ids = batch.column("doc_id").slice(first, len(part))
                keys, packed, counts, rare = [], [], [], []
                for text, doc_id in zip(part.to_pylist(), ids.to_pylist(), strict=True):
                    own = split(text or "")
                    numbers = np.fromiter((number.get(w, other) for w in own), np.int64, len(own))
                    keys.append(xxhash.xxh3_64_intdigest(f"{doc_id}\0{text or ''}") - (1 << 63))
                    packed.append(_packed_numbers(numbers))
                    counts.append(len(own))
                    rare.append(_packed_words([own[k] for k in np.flatnonzero(numbers == other)]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64()),
                        ids,
                        pa.array(packed, pa.binary()),
                        pa.array(counts, pa.int32()),
                        pa.array(rare, pa.binary()),
                    ],
                    names=["key", "doc_id", "numbers", "n_words", "others"],
                )

    @releasing
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 200):
                part = batch.slice(first, 200)
                found = [_unpacked_words(x) for x in part.column("others").to_pylist()]
                counts = list(map(len, found))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(part.column("key").to_numpy(), counts)),
                        pa.array(chain.from_iterable(map(range, counts)), pa.int32()),
                        pa.array(chain.from_iterable(found), pa.string()),
                    ],
                    names=["key", "at", "word"],
                )

    @releasing
    def assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Head = shared.value
        for batch in batches:
            ids = batch.column("doc_id")
            first, held, words_held = 0, [], 0
            for k, row in enumerate(batch.select(["numbers", "n_words", "rare"]).to_pylist()):
                held.append(row)
                words_held += row["n_words"]
                if words_held > 300_000 or k == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(first, len(held)), pa.array(_assembled(known, held), pa.binary())],
                        names=["doc_id", "ids"],
                    )
                    first, held, words_held = k + 1, [], 0

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Both uses read all columns, so one exchange serves both and texts are not split once more.
    split = texts.mapInArrow(
        numbered, "key long, doc_id long, numbers binary, n_words int, others binary"
    ).repartition("key")
    rare = (
        split.mapInArrow(spread, "key long, at int, word string")
        .join(others.select("word", "ids"), "word")
        .groupBy("key")
        .agg(F.sort_array(F.collect_set(F.struct("at", "ids")))["ids"].alias("rare"))
    )
    return split.join(rare, "key", "left").mapInArrow(assembled, "doc_id long, ids binary")


def _assembled(known: Head, rows: list[dict]) -> list[bytes]:
    """Ids of each document from its word numbers and the ids of its other words in their order."""
    counts = np.array([row["n_words"] for row in rows], dtype=np.int64)
    numbers = np.concatenate([_unpacked_numbers(row["numbers"], row["n_words"]) for row in rows])
    found = [ids for row in rows for ids in row["rare"] or ()]
    own, bounds = _joined(found)
    numbers[numbers == len(known.words)] = len(known.words) + np.arange(len(found))
    ids = np.concatenate([known.ids, own])
    joint = np.concatenate([known.bounds, known.bounds[-1] + bounds[1:]])
    lengths = np.concatenate([[0], np.cumsum(np.diff(joint)[numbers])])
    whole = _gather(ids, joint, numbers).astype("<u4")
    cuts = lengths[np.append(0, np.cumsum(counts))]
    return [whole[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with n_tokens, ids_sha256, text and decoded_sha256.

    The text is what the tokenizer's decoder gives with special tokens kept: it has no decoder
    of its own, so pieces are joined by a space. The pieces are a table as long as the vocabulary.
    """
    pieces = encoded.sparkSession.sparkContext.broadcast(splitter(path).pieces())

    @releasing
    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.array(pieces.value, dtype=object)
        for batch in batches:
            packed = batch.column("ids").to_pylist()
            for first in range(0, len(packed), 500):
                part = packed[first : first + 500]
                texts = [" ".join(known[np.frombuffer(x, dtype="<u4")]) for x in part]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(part)),
                        batch.column("ids").slice(first, len(part)),
                        pa.array([len(x) // 4 for x in part], pa.int64()),
                        pa.array([sha256(x).hexdigest() for x in part]),
                        pa.array(texts, pa.string()),
                        pa.array([sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in texts]),
                    ],
                    names=["doc_id", "ids", "n_tokens", "ids_sha256", "text", "decoded_sha256"],
                )

    return encoded.mapInArrow(
        decoded, "doc_id long, ids binary, n_tokens long, ids_sha256 string, text string, decoded_sha256 string"
    )
