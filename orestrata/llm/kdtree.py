"""K-d trees over letter counts, for words that differ by one edit.

A word is the vector of its letters' counts, followed by those of its first and of its last letters. One edit adds
at most one letter and takes away at most one, so the L1 distance is at most two; and as it falls
in the beginning or in the end or in neither, so is the distance of these two together. A node holds the
box of its vectors; a search leaves out boxes which gain or lose too much.

Counts are in unary code, a bit for each letter and height: what a count exceeds another by is the number of bits
it alone has, and the box of some vectors is the bits all have and the bits any has. Heights beyond ``HEIGHT`` are not
coded, and accented letters only as present, which never makes a distance larger; letter order decides in the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: First and last letters counted apart (words are as long as both); unary heights of a to z in a word (four fit
#: two numbers) and in its ends.
BEGINNING, END = 4, 3
HEIGHT, HEIGHT_OF_ENDS = 4, 2
#: Numbers of 64 bits for a word: counts of a to z (two), presence of U+00C0 to U+00FF, the beginning, the end.
NUMBERS = 5
_WHOLE, _ENDS = (0, 1, 2), (3, 4)
#: Vectors of a leaf, and elements in an intermediate array.
LEAF = 32
BLOCK = 2_000_000


@dataclass(frozen=True)
class Reach:
    """What a word may gain and lose on its way to another: of the same length, or a letter shorter."""

    gain: int
    lose: int


SAME_LENGTH, ONE_SHORTER = Reach(1, 1), Reach(0, 1)
_OF_ENDS = Reach(1, 1)


def codes(words: list[str]) -> np.ndarray:
    """Letter numbers of equally long words, one row per word: a to z from 0, U+00C0 to U+00FF from 26."""
    size = len(words[0]) if words else 0
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(len(words), size)
    return np.where(points < 0xC0, points - 0x61, points - 0xC0 + 26).astype(np.uint8)


def _counts(letters: np.ndarray) -> np.ndarray:
    flat = np.arange(len(letters))[:, None] * 90 + letters
    return np.bincount(flat.ravel(), minlength=len(letters) * 90).reshape(len(letters), 90)


def _unary(counts: np.ndarray, heights: int) -> np.ndarray:
    """One boolean per letter and height, height by height."""
    return np.concatenate([counts > height for height in range(heights)], axis=1)


def _packed(bits: np.ndarray, numbers: int) -> np.ndarray:
    """Booleans of each row as so many 64-bit numbers."""
    whole = np.zeros((len(bits), 64 * numbers), dtype=bool)
    whole[:, : bits.shape[1]] = bits
    return np.packbits(whole, axis=1, bitorder="little").view("<u8")


def vectors(letters: np.ndarray) -> np.ndarray:
    """The unary code of each word, ``NUMBERS`` numbers of 64 bits."""
    whole = _counts(letters)
    parts = [_packed(_unary(whole[:, :26], HEIGHT), 2), _packed(whole[:, 26:] > 0, 1)]
    for end in (_counts(letters[:, :BEGINNING]), _counts(letters[:, -END:])):
        accented = end[:, 26:].any(axis=1, keepdims=True)
        parts.append(_packed(np.concatenate([_unary(end[:, :26], HEIGHT_OF_ENDS), accented], axis=1), 1))
    return np.concatenate(parts, axis=1)


def _count(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits)


def within(values: np.ndarray, low: np.ndarray, high: np.ndarray, reach: Reach) -> np.ndarray:
    """Numbers of the vectors which can reach the box with one edit; each test is made of those left by the one before."""
    rows = np.arange(len(values))
    for numbers, limits in ((_ENDS, _OF_ENDS), (_WHOLE, reach)):
        for lost, most in ((True, limits.lose), (False, limits.gain)):
            total = 0
            for k in numbers:
                own = values[rows, k]
                total = total + (_count(own & ~high[k]) if lost else _count(low[k] & ~own))
            rows = rows[total <= most]
    return rows


def pairs_within(values: np.ndarray, others: np.ndarray, reach: Reach) -> tuple[np.ndarray, np.ndarray]:
    """(number of a vector, number of another) of which one edit can make the one the other."""
    lose = 0
    for k in _ENDS:
        lose = lose + _count(values[:, k, None] & ~others[None, :, k])
    a, b = np.nonzero(lose <= _OF_ENDS.lose)
    for numbers, most, of, not_in in (
        (_ENDS, _OF_ENDS.gain, others, values),
        (_WHOLE, reach.lose, values, others),
        (_WHOLE, reach.gain, others, values),
    ):
        lone = 0
        for k in numbers:
            x, y = (of[a, k], not_in[b, k]) if of is values else (of[b, k], not_in[a, k])
            lone = lone + _count(x & ~y)
        a, b = a[lone <= most], b[lone <= most]
    return a, b


def _bits(values: np.ndarray, bit: int) -> np.ndarray:
    return (values[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1) > 0


def _split(values: np.ndarray) -> int | None:
    """The bit (a count above or below a height) that halves the vectors best; None if all are equal."""
    bits = np.unpackbits(np.ascontiguousarray(values).view(np.uint8), axis=1, bitorder="little")
    have = bits.sum(axis=0, dtype=np.int64)
    smaller = np.minimum(have, len(values) - have)
    bit = int(smaller.argmax())
    return bit if smaller[bit] else None


class Tree:
    """``members[k]`` are the numbers of the vectors in leaf k; ``boxes[node]`` is (low, high)."""

    def __init__(self, values: np.ndarray, leaf: int = LEAF, tight: bool = True):
        """Boxes are those of the vectors if ``tight``, else what the splits alone leave of the space."""
        self.boxes: list[tuple[np.ndarray, np.ndarray]] = []
        self.split: list[list[int] | None] = []
        self.leaf_of: dict[int, int] = {}
        self.members: list[np.ndarray] = []
        space = np.zeros(NUMBERS, np.uint64), np.full(NUMBERS, 2**64 - 1, np.uint64)
        todo = [(np.arange(len(values)), space, -1, 0)]
        while todo:
            rows, box, parent, side = todo.pop()
            own = values[rows]
            node = len(self.boxes)
            if tight and len(rows):
                box = np.bitwise_and.reduce(own, axis=0), np.bitwise_or.reduce(own, axis=0)
            self.boxes.append(box)
            if parent >= 0:
                self.split[parent][side] = node
            bit = _split(own) if len(rows) > leaf else None
            if bit is None:
                self.split.append(None)
                self.leaf_of[node] = len(self.members)
                self.members.append(rows if tight else np.zeros(0, np.int64))
                continue
            self.split.append([-1, -1, bit])
            upper = _bits(own, bit)
            mask = np.zeros(NUMBERS, np.uint64)
            mask[bit // 64] = np.uint64(1) << np.uint64(bit % 64)
            todo.append((rows[~upper], (box[0], box[1] & ~mask), node, 0))
            todo.append((rows[upper], (box[0] | mask, box[1]), node, 1))

    def home(self, values: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        leaves = np.zeros(len(values), dtype=np.int64)
        todo = [(0, np.arange(len(values)))]
        while todo:
            node, rows = todo.pop()
            if self.split[node] is None:
                leaves[rows] = self.leaf_of[node]
                continue
            left, right, bit = self.split[node]
            upper = _bits(values[rows], bit)
            todo += [(left, rows[~upper]), (right, rows[upper])]
        return leaves

    def reached(self, values: np.ndarray, reach: Reach) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, numbers of the vectors which can reach its box with one edit)."""
        step = BLOCK // NUMBERS
        for first in range(0, len(values), step):
            todo = [(0, np.arange(first, min(first + step, len(values))))]
            while todo:
                node, rows = todo.pop()
                rows = rows[within(values[rows], *self.boxes[node], reach)]
                if not len(rows):
                    continue
                if self.split[node] is None:
                    yield self.leaf_of[node], rows
                else:
                    todo += [(child, rows) for child in self.split[node][:2]]


def one_edit(longer: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Whether each pair of words (rows of letters) differs by one letter replaced, or one more in the longer."""
    if longer.shape[1] == shorter.shape[1]:
        return (longer != shorter).sum(axis=1) == 1
    size = shorter.shape[1]
    front = np.logical_and.accumulate(longer[:, :size] == shorter, axis=1).sum(axis=1)
    back = np.logical_and.accumulate((longer[:, 1:] == shorter)[:, ::-1], axis=1).sum(axis=1)
    return front + back >= size


class Words:
    """Equally long words under a tree."""

    def __init__(self, words: list[str]):
        self.letters = codes(words)
        self.vectors = vectors(self.letters)
        self.tree = Tree(self.vectors)

    def near(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number among ``words``, own number) of the pairs one edit apart; ``words`` are of the own length, or one longer."""
        letters = codes(words)
        values = vectors(letters)
        reach = SAME_LENGTH if letters.shape[1] == self.letters.shape[1] else ONE_SHORTER
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for leaf, rows in self.tree.reached(values, reach):
            members = self.tree.members[leaf]
            step = max(1, BLOCK // (len(members) * NUMBERS))
            for first in range(0, len(rows), step):
                part = rows[first : first + step]
                asked, at = pairs_within(values[part], self.vectors[members], reach)
                asked, at = part[asked], members[at]
                true = one_edit(letters[asked], self.letters[at])
                found.append((asked[true], at[true]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])
