"""Eigendecompositions kept up to date by rank-one changes."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps


def secular_roots(poles: np.ndarray, squares: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(squares / (poles - x)), one behind each pole, and the matrix poles[i] - root[j].

    Poles rise, squares and rho are positive. A root is held as its distance
    from the nearer pole, so that differences to the poles keep their digits.
    Steps follow the rational function through both neighbouring poles and
    fall back to halving the bracket.
    """
    k = len(poles)
    after = np.append(poles[1:], poles[-1] + rho * squares.sum())
    gap = after - poles
    middle = (poles[:, None] - poles[None, :]) - gap / 2
    at_middle = 1 / rho + (squares[:, None] / middle).sum(axis=0)
    # Above zero in the middle: the root lies in the left half, nearer to its own pole.
    left = at_middle >= 0
    left[-1] = True
    origin = np.where(left, poles, after)
    low = np.where(left, 0.0, -gap / 2)
    high = np.where(left, gap / 2, 0.0)
    if at_middle[-1] < 0:
        low[-1] = gap[-1] / 2
    high[-1] = high[-1] if at_middle[-1] >= 0 else gap[-1]
    shifted = poles[:, None] - origin[None, :]
    root = (low + high) / 2
    own, below = np.arange(k), np.tri(k, dtype=bool).T  # below[i, j]: pole i is at or left of root j
    next_shift = after - origin
    for _ in range(100):
        delta = shifted - root
        terms = squares[:, None] / delta
        value = 1 / rho + terms.sum(axis=0)
        done = np.abs(value) <= 8 * k * EPS * (1 / rho + np.abs(terms).sum(axis=0))
        if done.all():
            break
        low, high = np.where(value < 0, root, low), np.where(value < 0, high, root)
        slopes = terms / delta
        slope_left = np.where(below, slopes, 0.0).sum(axis=0)
        slope_right = slopes.sum(axis=0) - slope_left
        d0, d1 = delta[own, own], next_shift - root
        a = (d0 + d1) * value - d0 * d1 * (slope_left + slope_right)
        b = d0 * d1 * value
        c = value - d0 * slope_left - d1 * slope_right
        with np.errstate(all="ignore"):
            spread = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            step = np.where(a <= 0, (a - spread) / (2 * c), 2 * b / (a + spread))
        tried = root + step
        inside = np.isfinite(tried) & (tried > low) & (tried < high)
        root = np.where(done, root, np.where(inside, tried, (low + high) / 2))
    return origin + root, shifted - root


def _deflated(values: np.ndarray, vectors: np.ndarray, z: np.ndarray, least: float) -> np.ndarray:
    """Which parts of z take part; of (nearly) equal values one takes over by a rotation. Changes z and vectors."""
    active = np.abs(z) > least
    kept = np.flatnonzero(active)
    if len(kept) < 2 or np.diff(values[kept]).min() > least:
        return active
    before = kept[0]
    for i in kept[1:]:
        if values[i] - values[before] <= least:
            r = np.hypot(z[before], z[i])
            c, s = z[i] / r, z[before] / r
            vectors[:, [before, i]] = np.stack([c * vectors[:, before] - s * vectors[:, i], s * vectors[:, before] + c * vectors[:, i]], axis=1)
            z[before], z[i] = 0.0, r
            active[before] = False
        before = i
    return active


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Rising eigenvalues and eigenvectors of ``vectors diag(values) vectors' + rho v v'``, rho positive.

    Parts of v along an eigenvector that are small to rounding, and repeated
    eigenvalues, are deflated; the others solve the secular equation. The
    eigenvectors come from the z that has the found roots exactly, which keeps
    them orthogonal.
    """
    z = vectors.T @ v
    size = np.sqrt(z @ z)
    if not size or not rho:
        return values, vectors
    z, rho = z / size, rho * size * size
    least = 8 * EPS
    scale = max(values[-1], rho)
    vectors = vectors.copy()
    active = _deflated(values / scale, vectors, z, least)
    kept = np.flatnonzero(active)
    if not len(kept):
        return values, vectors
    poles = values[kept]
    roots, delta = secular_roots(poles, z[kept] ** 2, rho)
    ratio = delta / np.where(np.eye(len(kept), dtype=bool), 1.0, poles[:, None] - poles[None, :])
    exact = np.copysign(np.sqrt(np.abs(ratio.prod(axis=1)) / rho), z[kept])
    turn = exact[:, None] / delta
    turn /= np.sqrt((turn * turn).sum(axis=0))
    values = values.copy()
    values[kept] = roots
    vectors[:, kept] = vectors[:, kept] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Count, mean and eigendecomposition of the scatter matrix of some vectors."""

    def __init__(self, dim: int):
        self.n, self.mean = 0, np.zeros(dim)
        self.values, self.vectors = np.zeros(dim), np.eye(dim)

    def add(self, x: np.ndarray) -> None:
        self.n += 1
        away = x - self.mean
        self.mean = self.mean + away / self.n
        self.values, self.vectors = rank_one(self.values, self.vectors, away, (self.n - 1) / self.n)
        if self.n % 1024 == 0:
            # Rounding piles up slowly; restore orthogonality.
            q, r = np.linalg.qr(self.vectors)
            self.vectors = q * np.sign(np.diag(r))

    def merge(self, other: "Spectrum") -> None:
        """Take over another spectrum: its eigenpairs one by one, then the distance of the means."""
        n = self.n + other.n
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, value)
        away = other.mean - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, away, self.n * other.n / n)
        self.n, self.mean = n, self.mean + away * (other.n / n)
