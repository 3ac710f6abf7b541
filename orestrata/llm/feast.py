"""Greatest eigenpairs of a symmetric matrix by contour integration (FEAST).

The spectrum is cut into intervals by counting eigenvalues below a shift: as many as the shifted
matrix has negative pivots (Sylvester's law of inertia). For each interval a quadrature over the circle
through its ends sums solutions of complex shifted systems, which projects a block of vectors onto the
interval's eigenspace; Rayleigh-Ritz extracts eigenpairs from the block. That repeats until residuals
are at round-off, and the number found must be the one which inertia counted.

The matrix is as wide as a vector has dimensions, whatever the number of rows, and is held here as a whole.
"""

from __future__ import annotations

import numpy as np

#: Quadrature nodes on the upper half circle, eigenvalues of an interval at most, rounds of refinement.
NODES = 16
MOST_INSIDE = 8
ROUNDS = 40
_EPS = np.finfo(np.float64).eps
_PIVOT = (1 + 17**0.5) / 8


def negative_pivots(matrix: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are negative: LDL' with complete pivoting of 1 x 1 and 2 x 2 blocks."""
    left, negative = np.array(matrix, dtype=np.float64), 0
    while len(left):
        diagonal = np.abs(np.diag(left))
        k = int(diagonal.argmax())
        off = np.abs(left - np.diag(np.diag(left)))
        i, j = divmod(int(off.argmax()), len(left))
        if diagonal[k] == 0 and off[i, j] == 0:
            return negative
        if diagonal[k] >= _PIVOT * off[i, j]:
            pivot = [k]
            negative += int(left[k, k] < 0)
        else:  # its determinant is negative, so one eigenvalue is
            pivot = [i, j]
            negative += 1
        rest = np.setdiff1d(np.arange(len(left)), pivot)
        across = left[np.ix_(rest, pivot)]
        left = left[np.ix_(rest, rest)] - across @ np.linalg.solve(left[np.ix_(pivot, pivot)], across.T)
        left = (left + left.T) / 2
    return negative


def count_below(matrix: np.ndarray, shift: float) -> int:
    return negative_pivots(matrix - shift * np.eye(len(matrix)))


def _cut(matrix: np.ndarray, low: float, high: float) -> tuple[float, int]:
    """A point near the middle with no eigenvalue close by, if one is found, and the count below it."""
    width = high - low
    for place in (0.5, 0.45, 0.55, 0.4, 0.6, 0.35, 0.65, 0.3, 0.7):
        at = low + place * width
        below = count_below(matrix, at - 0.01 * width)
        if below == count_below(matrix, at + 0.01 * width):
            return at, below
    return low + width / 2, count_below(matrix, low + width / 2)


def intervals(matrix: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside) that hold the ``wanted`` greatest, the greatest first.

    An interval which no cut makes smaller holds one eigenvalue many times, to working precision.
    """
    size = len(matrix)
    bound = float(np.abs(matrix).sum(axis=1).max()) * (1 + 1e-6) or 1.0
    todo, done = [(-bound, bound, 0, size)], []
    while todo:
        low, high, below_low, below_high = todo.pop()
        if below_high == below_low or below_high <= size - wanted:
            continue
        if below_high - below_low <= MOST_INSIDE and low > -bound or high - low <= 64 * size * _EPS * bound:
            done.append((low, high, below_high - below_low))
            continue
        at, below = _cut(matrix, low, high)
        todo += [(low, at, below_low, below), (at, high, below, below_high)]
    return sorted(done, reverse=True)


def _projected(matrix: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    """The spectral projector of the interval applied to the block, by quadrature."""
    middle, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(0.5j * np.pi * (1 + nodes))
    shifted = (middle + radius * turns)[:, None, None] * np.eye(len(matrix)) - matrix
    solved = np.linalg.solve(shifted, np.broadcast_to(block.astype(complex), (NODES, *block.shape)))
    return np.einsum("k,kij->ij", weights / 2 * radius * turns, solved).real


def _ritz(matrix: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    basis, _ = np.linalg.qr(block)
    reduced = basis.T @ matrix @ basis
    values, vectors = np.linalg.eigh((reduced + reduced.T) / 2)
    return values, basis @ vectors


def _inside(matrix: np.ndarray, low: float, high: float, count: int, draw: np.random.Generator) -> np.ndarray:
    """Eigenvectors (columns) of the ``count`` eigenvalues between low and high."""
    size = len(matrix)
    bound = np.abs(matrix).sum(axis=1).max()
    edge = 8 * size * _EPS * bound
    width = min(size, 2 * count + 8)
    block = draw.standard_normal((size, width))
    worst, best = np.inf, None
    for _ in range(ROUNDS):
        values, vectors = _ritz(matrix, _projected(matrix, block, low, high))
        chosen = np.flatnonzero((values >= low - edge) & (values <= high + edge))
        residuals = np.abs(matrix @ vectors - vectors * values).max(axis=0)
        true = chosen[residuals[chosen] <= 1e-6 * bound]  # a Ritz value between far ones is no eigenvalue
        if len(true) == count:
            now = residuals[true].max()
            if now >= worst / 2 and worst <= 64 * size * _EPS * bound:
                return best
            if now < worst:
                worst, best = now, vectors[:, true]
        block = vectors
    if best is None or worst > 1e-10 * bound:
        raise ArithmeticError(f"{count} eigenvalues lie between {low} and {high}, but they were not all found")
    return best


def greatest_eigenpairs(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns); all of them if there are fewer than ``wanted``."""
    size = len(matrix)
    wanted = min(wanted, size)
    if not wanted:
        return np.zeros(0), np.zeros((size, 0))
    matrix = (matrix + matrix.T) / 2
    draw = np.random.default_rng(1)
    found = [_inside(matrix, low, high, count, draw) for low, high, count in intervals(matrix, wanted)]
    values, vectors = _ritz(matrix, np.concatenate(found, axis=1))
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], vectors[:, order]
