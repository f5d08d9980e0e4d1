"""The largest eigenvalues of a symmetric matrix by FEAST, checked by inertia.

Counts of eigenvalues above a shift (negative pivots of the shifted tridiagonal form)
find where the wanted eigenvalues end and cut them into intervals at wide gaps. For
each interval, complex shifted solves at the nodes of a Gauss quadrature around it
project a subspace onto its eigenvectors; Rayleigh-Ritz on the projected space gives
values and vectors, and iterating sharpens them. As many vectors as the counts tell
must be found in each interval, else the interval is done again with a larger subspace.
"""

from __future__ import annotations

import numpy as np

NODES = 12
ROUNDS = 60
CLUSTER = 1e-7
ENOUGH = 3e-15


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the same eigenvalues."""
    a = matrix.copy()
    for k in range(len(a) - 2):
        column = a[k + 1 :, k].copy()
        size = np.linalg.norm(column)
        if size == 0:
            continue
        column[0] += np.copysign(size, column[0])
        column /= np.linalg.norm(column)
        rest = a[k + 1 :, k + 1 :]
        turned = rest @ column
        turned -= column * (column @ turned)
        rest -= 2 * (np.outer(column, turned) + np.outer(turned, column))
        a[k + 1, k] = a[k, k + 1] = -np.copysign(size, a[k + 1, k])
    return np.diag(a).copy(), np.diag(a, -1).copy()


def above(form: tuple[np.ndarray, np.ndarray], shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie above each shift, by the signs of the pivots."""
    middle, side = form
    shifts = np.asarray(shifts, float)
    least = np.finfo(float).tiny / np.finfo(float).eps * max(1.0, np.max(side**2, initial=0.0))
    count = np.zeros(shifts.shape, int)
    pivot = np.ones(shifts.shape)
    for k, value in enumerate(middle):
        pivot = value - shifts - (side[k - 1] ** 2 / pivot if k else 0)
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        count += pivot > 0
    return count


def located(form, number: int, low: float, high: float) -> np.ndarray:
    """The largest ``number`` eigenvalues, falling, to a rough precision, by their counts."""
    lows, highs = np.full(number, low), np.full(number, high)
    place = np.arange(1, number + 1)
    for _ in range(40):
        between = (lows + highs) / 2
        up = above(form, between) >= place
        lows, highs = np.where(up, between, lows), np.where(up, highs, between)
    return (lows + highs) / 2


def _intervals(values: np.ndarray, low: float, high: float, most: int) -> list[tuple[float, float]]:
    """Intervals around falling values, cut at their widest gaps, not inside a cluster."""
    if len(values) > most:
        gaps = values[:-1] - values[1:]
        cut = int(np.argmax(gaps * np.minimum(np.arange(1, len(values)), np.arange(1, len(values))[::-1])))
        if gaps[cut] > CLUSTER * high:
            edge = (values[cut] + values[cut + 1]) / 2
            return _intervals(values[: cut + 1], edge, high, most) + _intervals(values[cut + 1 :], low, edge, most)
    return [(low, high)]


def _projected(inverses, matrix, low, high, space):
    """The subspace sent through the quadrature of the contour, then Rayleigh-Ritz."""
    made = np.zeros_like(space)
    for turn, weight, inverse in inverses:
        made += weight * (turn * (inverse @ space)).real
    basis, _ = np.linalg.qr(made)
    basis, _ = np.linalg.qr(basis)
    values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
    vectors = basis @ turned
    inside = (values > low) & (values < high)
    return values, vectors, inside


def _of_interval(matrix, low, high, number, draw) -> np.ndarray:
    """Eigenvectors of all ``number`` eigenvalues between low and high."""
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    middle, radius = (low + high) / 2, (high - low) / 2
    inverses = []
    for node, weight in zip(nodes, weights, strict=True):
        turn = radius * np.exp(1j * np.pi / 2 * (node + 1))
        shifted = (middle + turn) * np.eye(len(matrix)) - matrix
        inverses.append((turn, weight / 2, np.linalg.inv(shifted)))
    size = min(len(matrix), 2 * number + 8)
    scale = np.abs(matrix).sum(axis=0).max()
    while True:
        space = draw.standard_normal((len(matrix), size))
        best, found = np.inf, None
        for _ in range(ROUNDS):
            values, space, inside = _projected(inverses, matrix, low, high, space)
            kept = space[:, inside]
            if kept.shape[1] == number:
                rest = np.linalg.norm(matrix @ kept - kept * values[inside], axis=0).max(initial=0) / scale
                if rest < best / 2:
                    best, found = rest, kept
                elif best < 1e-12:
                    break
                if rest < ENOUGH:
                    break
        if found is not None and best < 1e-12:
            return found
        if size == len(matrix):
            raise ArithmeticError(f"{number} eigenvalues lie between {low} and {high}, but they were not found")
        size = min(len(matrix), 2 * size)


def largest(matrix: np.ndarray, number: int, most: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """The ``number`` largest eigenvalues, falling, and unit eigenvectors as columns.

    ``matrix`` is symmetric. Eigenvalues equal to the last one are computed too, so
    what comes back is orthonormal and complete. ``most`` is how many eigenvalues an
    interval has, but for clusters. A vector's entry of greatest size is positive.
    """
    size = len(matrix)
    number = min(number, size)
    if not number:
        return np.empty(0), np.empty((size, 0))
    scale = np.abs(matrix).sum(axis=0).max()
    if scale == 0:
        return np.zeros(number), np.eye(size)[:, :number]
    matrix = matrix / scale
    form = tridiagonal(matrix)
    values = located(form, size, -1.01, 1.01)
    count = number
    while count < size and values[count - 1] - values[count] <= CLUSTER:
        count += 1
    low = -1.02 if count == size else (values[count - 1] + values[count]) / 2
    # So far above the greatest that the interval does not end at it.
    high = min(1.02, values[0] + max(1e-3, (values[0] - low) / 8))
    draw = np.random.default_rng(13)
    parts = []
    for start, end in _intervals(values[:count], low, high, most):
        inside = int(np.subtract(*above(form, np.array([start, end]))))
        parts.append(_of_interval(matrix, start, end, inside, draw))
    basis, _ = np.linalg.qr(np.concatenate(parts, axis=1))
    if basis.shape[1] != int(np.subtract(*above(form, np.array([low, high])))):
        raise ArithmeticError("an eigenvalue was missed")
    found, turned = np.linalg.eigh(basis.T @ matrix @ basis)
    vectors = (basis @ turned)[:, ::-1][:, :number]
    vectors /= np.linalg.norm(vectors, axis=0)
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(number)])
    return found[::-1][:number] * scale, vectors * sign
