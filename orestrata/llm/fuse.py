"""Static binary-fuse filters of 8-bit fingerprints over 64-bit keys, built and probed by numpy.

Every key owns one cell in each of three consecutive segments; the three cells XOR to its
fingerprint. Keys are peeled in rounds: a cell with one key left determines that key, and
all such cells of a round are independent of each other, so a round is a few array steps.
"""

from __future__ import annotations

import math
import struct

import numpy as np

from orestrata.llm.text import U64, mix

_HEAD = struct.Struct("<QIII")


def _layout(count: int) -> tuple[int, int]:
    """Segment length (a power of two) and number of segments a key may start in."""
    if count < 2:
        return 4, 1
    length = min(1 << 18, 1 << max(2, int(math.log(count) / math.log(3.33) + 2.25)))
    spare = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(count))
    return length, max(1, math.ceil(count * spare / length) - 2)


def _cells(keys: np.ndarray, seed: int, length: int, starts: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(keys + U64(seed))
    first = ((h >> U64(32)) * U64(starts * length)) >> U64(32)
    mask = U64(length - 1)
    second = (first + U64(length)) ^ ((h >> U64(18)) & mask)
    third = (first + U64(2 * length)) ^ (h & mask)
    print_ = ((h ^ (h >> U64(32))) & U64(255)).astype(np.uint8)
    return np.stack([first, second, third], axis=1).astype(np.int64), print_


def build(keys: np.ndarray) -> bytes:
    """A filter over the distinct keys; it says yes to each of them, and to one other in 256."""
    keys = np.unique(keys.astype(U64))
    length, starts = _layout(len(keys))
    size = (starts + 2) * length
    for attempt in range(100):
        seed = int(mix(np.array([attempt + 1], dtype=U64))[0])
        cells, prints = _cells(keys, seed, length, starts)
        load = np.bincount(cells.ravel(), minlength=size)
        total = np.bincount(cells.ravel(), weights=np.repeat(np.arange(len(keys), dtype=float), 3), minlength=size)
        rounds, left = [], len(keys)
        single = np.flatnonzero(load == 1)
        while left and len(single):
            key, at = np.unique(total[single].astype(np.int64), return_index=True)
            rounds.append((key, single[at]))
            left -= len(key)
            touched = cells[key].ravel()
            np.subtract.at(load, touched, 1)
            np.subtract.at(total, touched, np.repeat(key, 3).astype(float))
            touched = np.unique(touched)
            single = touched[load[touched] == 1]
        if left:
            continue
        table = np.zeros(size, dtype=np.uint8)
        for key, at in reversed(rounds):
            own = cells[key]
            others = table[own[:, 0]] ^ table[own[:, 1]] ^ table[own[:, 2]] ^ table[at]
            table[at] = prints[key] ^ others
        return _HEAD.pack(seed, length, starts, len(keys)) + table.tobytes()
    raise RuntimeError("no binary-fuse layout found for the given keys")


def contains(image: bytes, keys: np.ndarray) -> np.ndarray:
    """Which of the keys may be in the set; false is certain."""
    seed, length, starts, count = _HEAD.unpack_from(image)
    if not count:
        return np.zeros(len(keys), dtype=bool)
    table = np.frombuffer(image, dtype=np.uint8, offset=_HEAD.size)
    cells, prints = _cells(keys.astype(U64), seed, length, starts)
    return (table[cells[:, 0]] ^ table[cells[:, 1]] ^ table[cells[:, 2]]) == prints
