"""Singular values and right singular vectors of a small square matrix by qd methods."""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``a, b, v``: reflections from both sides leave the upper bidiagonal matrix with the
    diagonal ``a`` and ``b`` beside it; ``v`` is the product of those from the right, so
    ``matrix = U B v.T``."""
    work = np.array(matrix, dtype=float)
    size = len(work)
    v = np.eye(size)
    for k in range(size):
        w, beta = _reflector(work[k:, k])
        work[k:, k:] -= beta * np.outer(w, w @ work[k:, k:])
        if k < size - 2:
            w, beta = _reflector(work[k, k + 1 :])
            work[k:, k + 1 :] -= beta * np.outer(work[k:, k + 1 :] @ w, w)
            v[:, k + 1 :] -= beta * np.outer(v[:, k + 1 :] @ w, w)
    return np.diagonal(work).copy(), np.diagonal(work, 1).copy(), v


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """``w, beta`` such that ``x - beta w (w x)`` has zeros after its first place."""
    scale = np.abs(x).max(initial=0.0)
    if scale == 0:
        return x, 0.0
    w = x / scale
    w[0] += np.copysign(np.sqrt(w @ w), w[0])
    return w, 2.0 / (w @ w)


def squared_singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The squared singular values of the bidiagonal matrix, largest first, by dqds.

    The transform works on squares ``q`` and ``e`` without a subtraction but that of the
    shift, which keeps small values as accurate, relative to themselves, as large ones. The
    shift is ``1 / sum(1 / d)`` of the transform without a shift, Newton's step from zero:
    it is never beyond the smallest value, so no step has to be taken back but for rounding.
    """
    found = []
    open_ = [(0.0, [float(x) for x in a**2], [float(x) for x in b**2])]
    while open_:
        base, q, e = open_.pop()
        for _ in range(200 * len(q) + 200):
            if len(q) == 1:
                found.append(base + q[0])
                break
            small = [i for i, x in enumerate(e) if x <= _EPS**2 * (base + q[i + 1])]
            if small:
                cut = small[-1] + 1
                open_.append((base, q[:cut], e[: cut - 1]))
                open_.append((base, q[cut:], e[cut:]))
                break
            plain, d = _transform(q, e, 0.0)
            shift = 0.0 if min(d) <= 0 else (1 - 4 * len(d) * _EPS) / sum(1 / x for x in d)
            after, d = _transform(q, e, shift)
            if shift and min(d) < 0:
                after, shift = plain, 0.0
            base += shift
            q, e = after
        else:
            raise ArithmeticError("the qd iteration did not come to an end")
    return np.array(sorted(found, reverse=True))


def _transform(q: list[float], e: list[float], shift: float):
    """One dqds step: ``(q, e)`` of the next matrix, and the ``d`` on the way."""
    d = q[0] - shift
    all_d, next_q, next_e = [d], [], []
    for i, x in enumerate(e):
        pivot = d + x
        ratio = q[i + 1] / pivot if pivot else 0.0
        next_q.append(pivot)
        next_e.append(x * ratio)
        d = d * ratio - shift
        all_d.append(d)
    next_q.append(d)
    return (next_q, next_e), all_d


def right_vectors(a: np.ndarray, b: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Unit right singular vectors of the bidiagonal matrix, a column for each square.

    Where ``b`` vanishes the matrix falls apart and a vector lives on one part. There the
    factors of ``B'B - s`` from above and from below are twisted together at the place
    where the remainder is smallest, and two short recurrences give the vector. Vectors of
    values that are very close are made orthogonal to each other.
    """
    size = len(a)
    parts, begin = [], 0
    norm = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    for end in [i + 1 for i, x in enumerate(b) if abs(x) <= _EPS * norm] + [size]:
        if end > begin:
            parts.append((begin, end, squared_singular_values(a[begin:end], b[begin : end - 1])))
        begin = end
    owned = sorted(((s, begin, end) for begin, end, found in parts for s in found), reverse=True)
    vectors = np.zeros((size, len(squares)))
    for column in range(len(squares)):
        square, begin, end = owned[column]
        close = [
            vectors[:, other]
            for other in range(column)
            if owned[other][1] == begin and owned[other][0] - square <= 1e-3 * owned[other][0]
        ]
        best, best_left = None, 0.0
        for z in _twisted(a[begin:end], b[begin : end - 1], square):
            full = np.zeros(size)
            full[begin:end] = z
            for _ in range(2):
                for other in close:
                    full -= (other @ full) * other
            left = np.sqrt(full @ full)
            if left > best_left:
                best, best_left = full / left, left
            if left > 0.1:
                break
        vectors[:, column] = best
    return vectors


def _twisted(a: np.ndarray, b: np.ndarray, square: float):
    """Unit vectors for one squared singular value, the best twist first."""
    size = len(a)
    if size == 1:
        yield np.ones(1)
        return
    tiny = np.finfo(float).tiny
    # Squares of the entries: B'B = L D L' with D = a^2 and L = b / a below the diagonal.
    q = np.maximum(a * a, tiny)
    lower = b / np.where(a == 0, np.sqrt(tiny), a)[:-1]
    above, down = np.empty(size - 1), np.empty(size)
    s = -square
    for i in range(size - 1):
        pivot = q[i] + s
        pivot = pivot if pivot else _EPS * max(square, tiny)
        above[i] = q[i] * lower[i] / pivot
        down[i] = s
        s = above[i] * lower[i] * s - square
    down[-1] = s
    below, up = np.empty(size - 1), np.empty(size)
    p = q[-1] - square
    for i in range(size - 2, -1, -1):
        up[i + 1] = p
        pivot = q[i] * lower[i] * lower[i] + p
        pivot = pivot if pivot else _EPS * max(square, tiny)
        ratio = q[i] / pivot
        below[i] = lower[i] * ratio
        p = p * ratio - square
    up[0] = p
    remainder = np.abs(down + up + square)
    for twist in np.argsort(remainder, kind="stable"):
        z = np.zeros(size)
        z[twist] = 1.0
        for i in range(twist - 1, -1, -1):
            z[i] = -above[i] * z[i + 1]
        for i in range(twist, size - 1):
            z[i + 1] = -below[i] * z[i]
        length = np.sqrt(z @ z)
        if np.isfinite(length):
            yield z / length


def right_singular(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``squares, v``: the squared singular values of a square matrix, largest first, and
    its right singular vectors as columns."""
    a, b, v = bidiagonalise(matrix)
    scale = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if scale == 0:
        return np.zeros(len(a)), v
    a, b = a / scale, b / scale
    squares = squared_singular_values(a, b)
    return squares * scale**2, v @ right_vectors(a, b, squares)
