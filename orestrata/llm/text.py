"""Words as 64-bit hashes, found in whole Arrow columns at once.

Texts are cut into chunks of a megabyte (a longer text is a chunk of its own), so
the arrays held at a time do not grow with the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
CHUNK_BYTES = 1_000_000

#: Bytes which part words: white space, or everything ASCII but letters.
WHITE_SPACE = np.zeros(256, dtype=bool)
WHITE_SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_LETTERS = np.ones(256, dtype=bool)
NOT_LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_STEP = U64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * _STEP)


def _powers(count: int) -> np.ndarray:
    out = np.full(max(count, 1), _BASE, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts (null: empty) and each text's start in them, the end last."""
    texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, dtype=kind)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    whole = np.frombuffer(data, dtype=np.uint8)[starts[0] : starts[-1]]
    return whole, (starts - starts[0]).astype(np.int64)


def chunks(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, slice) of at most ``CHUNK_BYTES`` each, or of one longer text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    first = 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, side="right")))
        yield first, texts.slice(first, last - first)
        first = last


def word_hashes(
    texts: pa.Array, separators: np.ndarray = WHITE_SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z lower-cased, in order, and each text's first word, the end last."""
    data, bounds = bytes_of(texts)
    size = len(data)
    if not size:
        return np.zeros(0, U64), np.zeros(len(bounds), np.int64)
    inside = ~separators[data]
    first = np.zeros(size + 1, dtype=bool)
    first[bounds] = True
    before = np.empty(size, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty(size, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    if not len(starts):
        return np.zeros(0, U64), np.zeros(len(bounds), np.int64)
    lengths = ends - starts
    letters = data[inside]
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(len(letters), dtype=np.int64) - np.repeat(firsts, lengths)
    terms = _BYTE_VALUE[_LOWER[letters]] * _powers(int(lengths.max()))[place]
    words = np.add.reduceat(terms, firsts)
    return mix(words + lengths.astype(U64) * _STEP), np.searchsorted(starts, bounds)


def of_each(bounds: np.ndarray) -> np.ndarray:
    """The row to which each element of a ragged array belongs."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def shingles(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``size`` words of each text, sorted; a shorter text is one shingle."""
    counts = np.diff(bounds)
    rows = of_each(bounds)
    left = bounds[1:][rows] - np.arange(len(words)) if len(words) else np.zeros(0, np.int64)
    whole = left >= size
    heads = np.flatnonzero(whole)
    values = np.zeros(len(heads), U64)
    for k in range(size):
        values = mix(values * _STEP + words[heads + k])
    owner = rows[heads]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        alone = np.zeros(len(short), U64)
        for k in range(size - 1):
            there = counts[short] > k
            at = np.minimum(bounds[short] + k, len(words) - 1)
            alone = np.where(there, mix(alone * _STEP + words[at]), alone)
        values = np.concatenate([values, mix(alone + counts[short].astype(U64))])
        owner = np.concatenate([owner, short])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(len(counts) + 1))


def find(sorted_values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted value in a sorted array, and whether it is there."""
    if not len(sorted_values):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
    return at, sorted_values[at] == wanted


def ragged(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column of the given element type."""
    flat = pa.array(values.view(np.int64) if values.dtype == U64 else values, type=kind)
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), flat)
