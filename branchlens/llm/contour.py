"""Largest eigenpairs of a symmetric matrix by contour integration (FEAST).

The quadrature of complex shifted solves around an interval projects onto the eigenvectors
whose eigenvalues lie in it; Rayleigh-Ritz extracts them. Inertia counts, the signs of the
pivots of a shifted factorisation, place the intervals and verify that none is missed.
"""

from __future__ import annotations

import numpy as np

POINTS = 12  # quadrature points on the upper half circle
CROWD = 6  # an interval with more eigenvalues is halved as long as it is wide enough
ROUNDS = 40
_BK = (1 + 17**0.5) / 8  # growth bound of the symmetric pivoting


def inertia_above(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of ``a`` are greater than ``shift``.

    Symmetric elimination with 1x1 and 2x2 pivots (Bunch and Kaufman); by Sylvester's law the
    pivots have as many positive eigenvalues as the shifted matrix.
    """
    m = a - shift * np.eye(len(a))
    count = 0
    while len(m):
        column = np.abs(m[1:, 0])
        if not len(column) or column.max() == 0:
            count += m[0, 0] > 0
            m = m[1:, 1:]
            continue
        r = int(column.argmax()) + 1
        row = np.abs(m[r]).copy()
        row[r] = 0
        wide = row.max()
        if abs(m[0, 0]) >= _BK * column.max() or abs(m[0, 0]) * wide >= _BK * column.max() ** 2:
            swap = 0
        elif abs(m[r, r]) >= _BK * wide:
            swap = r
        else:  # rows 0 and r together; their determinant is negative: one eigenvalue of each sign
            order = [0, r, *(i for i in range(1, len(m)) if i != r)]
            m = m[np.ix_(order, order)]
            count += 1
            m = m[2:, 2:] - m[2:, :2] @ np.linalg.solve(m[:2, :2], m[:2, 2:])
            m = (m + m.T) / 2
            continue
        if swap:
            order = [swap, *(i for i in range(len(m)) if i != swap)]
            m = m[np.ix_(order, order)]
        count += m[0, 0] > 0
        m = m[1:, 1:] - np.outer(m[1:, 0], m[1:, 0]) / m[0, 0]
    return int(count)


def _projected(a: np.ndarray, low: float, high: float, y: np.ndarray) -> np.ndarray:
    """The quadrature of the resolvent around [low, high], applied to ``y``."""
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    turn = np.exp(0.5j * np.pi * (1 + nodes)) * (high - low) / 2
    out = np.zeros_like(y)
    for w, t in zip(weights, turn, strict=True):
        z = (low + high) / 2 + t
        out += 0.5 * w * (t * np.linalg.solve(z * np.eye(len(a)) - a, y.astype(complex))).real
    return out


def _interval(a: np.ndarray, low: float, high: float, count: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs in (low, high], their values falling."""
    d = len(a)
    size = min(d, max(count + 4, 2 * count))
    y = np.random.default_rng(12).standard_normal((d, size))
    last = np.inf
    for step in range(1, ROUNDS + 1):
        q, _ = np.linalg.qr(_projected(a, low, high, y) if size < d else y)
        values, small = np.linalg.eigh(q.T @ a @ q)
        y = q @ small
        inside = np.flatnonzero((values > low) & (values <= high))
        if len(inside) == count:
            worst = np.linalg.norm(a @ y[:, inside] - y[:, inside] * values[inside], axis=0).max()
            # Rounding level, or no more to be gained.
            if worst <= 1e-15 * scale or (worst <= 1e-11 * scale and worst > last / 2):
                return values[inside][::-1], y[:, inside][:, ::-1]
            last = worst
        if step % 10 == 0 and size < d:  # many eigenvalues just outside: a larger subspace
            size = min(d, 2 * size)
            y = np.hstack([y, np.random.default_rng(step).standard_normal((d, size - y.shape[1]))])
    raise ArithmeticError(f"no convergence for the eigenvalues in ({low}, {high}]")


def _clear(a: np.ndarray, at: float, step: float) -> float:
    """A border near ``at`` with no eigenvalue within ``step`` of it, where there is one."""
    for i in range(8):
        border = at + 4 * i * step
        if inertia_above(a, border - step) == inertia_above(a, border + step):
            return border
    return at


def largest_eigenpairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The up to ``k`` largest positive eigenvalues, falling, and unit eigenvectors as columns.

    Eigenvalues within rounding of zero, against the largest, count as zero and are left out.
    Of each vector the entry with the largest absolute value is positive.
    """
    d = len(a)
    scale = float(np.abs(a).sum(axis=1).max()) if d else 0.0
    if scale == 0 or k < 1:
        return np.zeros(0), np.zeros((d, 0))
    floor = 4 * d * np.finfo(float).eps * scale
    step = 16 * np.finfo(float).eps * d * scale
    top = scale * (1 + 1e-9) + 2 * step
    above = {floor: inertia_above(a, floor), top: 0}
    open_, found, border = [(floor, top)], [], top
    while open_ and sum(len(v) for v, _ in found) < k:
        low, high = open_.pop()
        count = above[low] - above[high]
        if count > CROWD and high - low > 64 * step:
            middle = _clear(a, (low + high) / 2, step)
            above[middle] = inertia_above(a, middle)
            open_ += [(low, middle), (middle, high)]
        else:
            border = low
            if count:
                found.append(_interval(a, low, high, count, scale))
    if not found:
        return np.zeros(0), np.zeros((d, 0))
    # All together once more, so that vectors of neighbouring intervals are orthogonal.
    q, _ = np.linalg.qr(np.hstack([v for _, v in found]))
    values, small = np.linalg.eigh(q.T @ a @ q)
    if int((values > border).sum()) != above[border]:
        raise ArithmeticError(f"{above[border]} eigenvalues above {border}, {len(values)} found")
    values, vectors = values[::-1][:k], (q @ small)[:, ::-1][:, :k]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values, vectors * signs
