"""Singular values and right singular vectors of a small triangle: Householder bidiagonal form, dqds, twisted factorisations."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
TINY = np.finfo(np.float64).tiny
CLOSE = 1e-3


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of B, and P, where R = Q B Pᵀ with Q and P orthogonal."""
    a = np.array(r, dtype=np.float64)
    n = a.shape[1]
    p = np.eye(n)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        """v and beta: (I - beta v vᵀ) x is a multiple of the first unit vector."""
        scale = np.abs(x).max(initial=0.0)
        if scale == 0 or not np.any(x[1:]):
            return x, 0.0
        v = x / scale
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        return v, 2.0 / float(v @ v)

    for j in range(n):
        v, beta = reflector(a[j:, j].copy())
        if beta:
            a[j:, j:] -= np.outer(beta * v, v @ a[j:, j:])
        if j + 2 < n:
            v, beta = reflector(a[j, j + 1:].copy())
            if beta:
                a[j:, j + 1:] -= np.outer(a[j:, j + 1:] @ v, beta * v)
                p[:, j + 1:] -= np.outer(p[:, j + 1:] @ v, beta * v)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), p


def dqds(q: list[float], e: list[float]) -> list[float]:
    """Eigenvalues of the tridiagonal BᵀB, ascending, from squares of B's diagonal (q) and superdiagonal (e).

    Each sweep is a differential quotient-difference transform with a shift no larger than the smallest eigenvalue left, so
    that all quantities stay positive and every value keeps its relative accuracy. A shift that was too large is taken back.
    """
    found: list[float] = []
    blocks = [(list(q), list(e), 0.0)]
    while blocks:
        q, e, shifted = blocks.pop()
        while q:
            n = len(q)
            if n == 1 or e[-1] <= EPS * EPS * (shifted + q[-1]):
                found.append(shifted + q.pop())
                if e:
                    e.pop()
                continue
            cut = next((i for i in range(n - 2, -1, -1) if e[i] <= EPS * EPS * (shifted + min(q[i], q[i + 1])) or e[i] < TINY), None)
            if cut is not None:
                blocks.append((q[:cut + 1], e[:cut], shifted))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if 1.5 * q[0] < q[-1]:  # small values converge at the end
                q, e = _turned(q, e)
            shift = _shift(q, e)
            while True:
                new_q, new_e, d = [], [], q[0] - shift
                for i in range(n - 1):
                    if d < 0:
                        break
                    new_q.append(d + e[i])
                    ratio = q[i + 1] / new_q[-1]
                    new_e.append(e[i] * ratio)
                    d = d * ratio - shift
                if len(new_e) == n - 1 and d >= 0:
                    break
                shift = shift / 4 if shift > TINY / EPS else 0.0
            q, e, shifted = [*new_q, d], new_e, shifted + shift
    return sorted(found)


def _turned(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The quotient-difference array of the same matrix with rows and columns in reverse order."""
    new_q, new_e, d = [], [], q[-1]
    for i in range(len(e) - 1, -1, -1):
        new_q.append(d + e[i])
        ratio = q[i] / new_q[-1]
        new_e.append(e[i] * ratio)
        d *= ratio
    return [*new_q, d], new_e


def _shift(q: list[float], e: list[float]) -> float:
    """A guess below the smallest eigenvalue: from the least pivot of a sweep without shift, and the last 2 x 2 corner."""
    d = least = q[0]
    for i in range(len(e)):
        d *= q[i + 1] / (d + e[i]) if d + e[i] else 0.0
        least = min(least, d)
    a, b, c = q[-2] + (e[-3] if len(e) > 2 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
    root = (a + b) / 2 - np.hypot((a - b) / 2, np.sqrt(c))
    # The pivot of a sweep is at most n times the smallest value and at least the value itself.
    return max(0.0, min(float(root), least) * (1 - 4 * EPS)) * (0.98 if least == d else 0.5)


def twisted(d: np.ndarray, f: np.ndarray, eigenvalue: float) -> np.ndarray:
    """Unit eigenvector of BᵀB from the twisted factorisation of BᵀB - eigenvalue whose middle pivot is least.

    Stationary transforms run from the top, progressive ones from the bottom.
    """
    n = len(d)
    pivots = d * d
    if n == 1:
        return np.ones(1)
    low = f / d[:-1]
    s, p = np.empty(n), np.empty(n)
    down, up = np.empty(n - 1), np.empty(n - 1)
    floor = TINY / EPS + EPS * EPS * eigenvalue

    def away(x: float) -> float:
        return x if abs(x) > floor else np.copysign(floor, x)

    s[0] = -eigenvalue
    for i in range(n - 1):
        pivot = away(s[i] + pivots[i])
        down[i] = low[i] * pivots[i] / pivot
        s[i + 1] = down[i] * low[i] * s[i] - eigenvalue
    p[-1] = pivots[-1] - eigenvalue
    for i in range(n - 2, -1, -1):
        ratio = pivots[i] / away(pivots[i] * low[i] * low[i] + p[i + 1])
        up[i] = low[i] * ratio
        p[i] = p[i + 1] * ratio - eigenvalue
    middle = np.abs(s + p + eigenvalue)
    middle[-1] = abs(s[-1] + pivots[-1])
    twist = int(np.argmin(middle))
    z = np.zeros(n)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(twist, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def right_singular(r: np.ndarray, rank: float = 1e-11) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of a triangle, falling, and unit right singular vectors as columns.

    Values whose root is at most `rank` times the largest one's are left out: they are rounding of a matrix of lower rank.
    """
    n = r.shape[1]
    scale = float(np.abs(r).max(initial=0.0))
    if not n or scale == 0 or not np.isfinite(scale):
        return np.zeros(0), np.zeros((n, 0))
    d, f, p = bidiagonalise(r / scale)
    norm = max(np.abs(d).max(), np.abs(f).max(initial=0.0))
    d = np.where(np.abs(d) > EPS * EPS * norm, d, EPS * EPS * norm)
    f = np.where(np.abs(f) > EPS * np.minimum(np.abs(d[:-1]), np.abs(d[1:])), f, 0.0)
    edges = [0, *(np.flatnonzero(f == 0) + 1).tolist(), n]
    blocks = [(start, d[start:end], f[start:end - 1]) for start, end in zip(edges, edges[1:])]
    found = [dqds((own_d**2).tolist(), (own_f**2).tolist())[::-1] for _, own_d, own_f in blocks]
    least = rank**2 * max(own[0] for own in found)
    values, vectors = [], []
    for (start, own_d, own_f), own in zip(blocks, found):
        for value, z in zip(own, _orthonormal(own_d, own_f, [v for v in own if v > least])):
            whole = np.zeros(n)
            whole[start:start + len(own_d)] = z
            values.append(value)
            vectors.append(whole)
    order = np.argsort(values, kind="stable")[::-1]
    columns = p @ np.array(vectors)[order].T
    return np.array(values)[order] * scale**2, columns / np.linalg.norm(columns, axis=0)


def _orthonormal(d: np.ndarray, f: np.ndarray, values: list[float]) -> list[np.ndarray]:
    """Unit eigenvectors of BᵀB for falling eigenvalues; those of close ones are made orthogonal."""
    out: list[np.ndarray] = []
    cluster: list[np.ndarray] = []

    def apart(z: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for other in cluster:
                z = z - (other @ z) * other
        return z

    for i, value in enumerate(values):
        if i and values[i - 1] - value > CLOSE * values[i - 1]:
            cluster = []
        z = apart(twisted(d, f, value))
        if not np.linalg.norm(z) > 0.5:
            # The same vector again: inverse iteration among those orthogonal to the others.
            t = np.diag(d * d + np.concatenate([[0.0], f * f])) + np.diag(d[:-1] * f, 1) + np.diag(d[:-1] * f, -1)
            shifted = t - (value + 4 * EPS * values[0]) * np.eye(len(d))
            z = apart(np.random.default_rng(i).normal(size=len(d)))
            for _ in range(4):
                z = apart(np.linalg.solve(shifted, z / np.linalg.norm(z)))
        z = z / np.linalg.norm(z)
        cluster.append(z)
        out.append(z)
    return out
