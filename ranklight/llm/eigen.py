"""Leading eigenpairs of a symmetric matrix: Householder, Sturm counts, inverse iteration."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal, and the unit vectors of the reflections that lead there.

    Reflection k leaves the first k + 1 coordinates alone.
    """
    a = np.array(a, float)
    n = len(a)
    reflections = []
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        length = np.linalg.norm(v)
        if np.linalg.norm(v[1:]) > 0:
            v[0] += np.copysign(length, v[0])
            v /= np.linalg.norm(v)
            rest = a[k + 1 :, k + 1 :]
            w = rest @ v
            w = 2 * (w - (v @ w) * v)
            rest -= np.outer(v, w) + np.outer(w, v)
            a[k + 1 :, k] -= 2 * v * (v @ a[k + 1 :, k])
        else:
            v[:] = 0
        reflections.append(v)
    return np.diag(a).copy(), np.array([a[k + 1, k] for k in range(n - 1)]), reflections


def counts_below(diagonal: np.ndarray, squares: np.ndarray, x: np.ndarray, least: float) -> np.ndarray:
    """How many eigenvalues lie below each ``x``: signs of the Sturm sequence's quotients."""
    count = np.zeros(len(x), int)
    q = np.ones(len(x))
    for d, s in zip(diagonal, np.concatenate(([0.0], squares))):
        q = d - x - s / q
        q = np.where(np.abs(q) < least, -least, q)
        count += q < 0
    return count


def largest_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bisected to the last bits."""
    n = len(diagonal)
    reach = np.abs(np.concatenate(([0.0], off))) + np.abs(np.concatenate((off, [0.0])))
    norm = max(float(np.abs(diagonal).max() + reach.max()), np.finfo(float).tiny)
    low = np.full(k, (diagonal - reach).min() - 2 * EPS * norm)
    high = np.full(k, (diagonal + reach).max() + 2 * EPS * norm)
    wanted = n - np.arange(k)  # eigenvalue j is the least x with so many at or below it
    for _ in range(200):
        middle = low + (high - low) / 2
        if ((high - low) <= 2 * EPS * np.maximum(np.abs(low), np.abs(high)) + EPS * EPS * norm).all():
            break
        below = counts_below(diagonal, off * off, middle, EPS * EPS * norm)
        high = np.where(below >= wanted, middle, high)
        low = np.where(below >= wanted, low, middle)
    return low + (high - low) / 2


def _solved(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, right: np.ndarray, least: float):
    """Solve (T - value) z = right for all values at once, with row exchanges."""
    n = len(diagonal)
    right = right.copy()
    zero = np.zeros(len(values))
    a, b, c = diagonal[0] - values, (off[0] if n > 1 else 0.0) + zero, zero
    rows = []
    for i in range(n - 1):
        sub = off[i] + zero
        na, nb = diagonal[i + 1] - values, (off[i + 1] if i + 2 < n else 0.0) + zero
        swap = np.abs(sub) > np.abs(a)
        pivot = np.where(swap, sub, a)
        pivot = np.where(np.abs(pivot) < least, least, pivot)
        p1, p2 = np.where(swap, na, b), np.where(swap, nb, c)
        o0, o1, o2 = np.where(swap, a, sub), np.where(swap, b, na), np.where(swap, c, nb)
        top, low = np.where(swap, right[i + 1], right[i]), np.where(swap, right[i], right[i + 1])
        factor = o0 / pivot
        rows.append((pivot, p1, p2))
        right[i], right[i + 1] = top, low - factor * top
        a, b, c = o1 - factor * p1, o2 - factor * p2, zero
    rows.append((np.where(np.abs(a) < least, least, a), zero, zero))
    z = np.zeros_like(right)
    for i in range(n - 1, -1, -1):
        pivot, p1, p2 = rows[i]
        z[i] = right[i]
        if i + 1 < n:
            z[i] -= p1 * z[i + 1]
        if i + 2 < n:
            z[i] -= p2 * z[i + 2]
        z[i] /= pivot
    return z


def vectors_of(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, seed: int = 5) -> np.ndarray:
    """Unit eigenvectors of falling ``values``, as columns.

    Inverse iteration from random vectors; vectors of values closer than a thousandth of the norm are
    made orthogonal to each other in every round.
    """
    n, k = len(diagonal), len(values)
    norm = max(float(np.abs(diagonal).max(initial=0) + 2 * np.abs(off).max(initial=0)), np.finfo(float).tiny)
    z = np.random.default_rng(seed).normal(size=(n, k))
    shifted = values.copy()
    for j in range(1, k):  # equal shifts would give equal vectors
        shifted[j] = min(shifted[j], shifted[j - 1] - 4 * EPS * norm)
    start = np.zeros(k, int)
    for j in range(1, k):
        start[j] = start[j - 1] if values[j - 1] - values[j] <= 1e-3 * norm else j
    for _ in range(6):
        z /= np.linalg.norm(z, axis=0)
        z = _solved(diagonal, off, shifted, z, EPS * norm)
        z /= np.abs(z).max(axis=0)
        z /= np.linalg.norm(z, axis=0)
        for j in range(k):
            near = z[:, start[j] : j]
            for _ in range(2):
                z[:, j] -= near @ (near.T @ z[:, j])
                z[:, j] /= np.linalg.norm(z[:, j])
    return z


def leading_eigenpairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    The entry of largest size of each vector is positive.
    """
    n = len(a)
    k = min(k, n)
    if not k:
        return np.zeros(0), np.zeros((n, 0))
    size = float(np.abs(a).max())
    if size == 0:
        return np.zeros(k), np.eye(n)[:, :k]
    diagonal, off, reflections = tridiagonal(a / size)
    values = largest_values(diagonal, off, k)
    z = vectors_of(diagonal, off, values)
    for r in range(len(reflections) - 1, -1, -1):
        v = reflections[r]
        z[r + 1 :] -= 2 * np.outer(v, v @ z[r + 1 :])
    z /= np.linalg.norm(z, axis=0)
    top = np.abs(z).argmax(axis=0)
    return values * size, z * np.where(z[top, np.arange(k)] < 0, -1.0, 1.0)
