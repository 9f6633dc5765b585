"""Estimates under bounds: the best point of a box, and the moments of a normal distribution cut to a box.

Both work on a batch of small matrices at once, one for each group.
"""

from __future__ import annotations

import math

import numpy as np

#: Sweeps over the coordinates, and the change that ends them.
SWEEPS, TOLERANCE = 2_000, 1e-13


def box_minimum(a: np.ndarray, r: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The point of the box with the smallest ``u a u / 2 - r u`` for each group; ``a`` (group, q, q) is positive definite.

    Coordinates are set to their best place inside the bounds one after another
    until none moves.
    """
    u = np.clip(np.linalg.solve(a, r[..., None])[..., 0], low, high)
    diagonal = np.einsum("gii->gi", a)
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(u.shape[1]):
            rest = r[:, j] - np.einsum("gk,gk->g", a[:, j], u) + diagonal[:, j] * u[:, j]
            new = np.clip(rest / diagonal[:, j], low[:, j], high[:, j])
            moved = max(moved, float(np.max(np.abs(new - u[:, j]) / (1 + np.abs(new)), initial=0.0)))
            u[:, j] = new
        if moved < TOLERANCE:
            break
    return u


def violation(a: np.ndarray, r: np.ndarray, u: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """How far each group is from the conditions of a minimum in the box, against the size of the gradient's terms.

    Inside the gradient is 0, on a bound it points outwards.
    """
    slope = np.einsum("gij,gj->gi", a, u) - r
    scale = np.abs(r) + np.einsum("gij,gj->gi", np.abs(a), np.abs(u)) + 1e-300
    at_low, at_high = u <= low, u >= high
    wrong = np.where(at_low & at_high, 0.0, np.where(at_low, np.maximum(0.0, -slope), np.where(at_high, np.maximum(0.0, slope), np.abs(slope))))
    return np.max(np.maximum(wrong / scale, ((u < low) | (u > high)).astype(float)), axis=1)


def _erfc(x: np.ndarray) -> np.ndarray:
    return np.array([math.erfc(v) for v in x.ravel()]).reshape(x.shape)


def _density(x: np.ndarray) -> np.ndarray:
    return np.where(np.isfinite(x), np.exp(-0.5 * np.where(np.isfinite(x), x, 0.0) ** 2), 0.0) / math.sqrt(2 * math.pi)


def cut_moments(mean: np.ndarray, variance: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and variance of normal numbers that lie between bounds."""
    sd = np.sqrt(variance)
    a, b = (low - mean) / sd, (high - mean) / sd
    flip = a > 0  # the upper tail is the exact one
    a, b = np.where(flip, -b, a), np.where(flip, -a, b)
    mass = 0.5 * (_erfc(-b / math.sqrt(2)) - _erfc(-a / math.sqrt(2)))
    with np.errstate(invalid="ignore", divide="ignore"):
        shift = (_density(a) - _density(b)) / mass
        ends = np.where(np.isfinite(a), a, 0.0) * _density(a) - np.where(np.isfinite(b), b, 0.0) * _density(b)
        second = 1 + ends / mass - shift**2
    far = ~(mass > 1e-250)  # the distribution lies at the nearer bound
    nearest = np.clip(mean, low, high)
    shift = np.where(flip, -shift, shift)
    out = np.where(far, nearest, np.clip(mean + sd * shift, low, high))
    return out, np.where(far, 0.0, np.maximum(second, 0.0) * variance)


def box_moments(mean: np.ndarray, cov: np.ndarray, low: np.ndarray, high: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of normal vectors cut to a box, for each group, by expectation propagation.

    One bound after another is replaced by a normal factor that gives the same
    moments of its coordinate, until nothing changes.  Exact with one bounded
    coordinate, or where the bounded ones are independent; else close to the moments.
    """
    groups, q = mean.shape
    bounded = [j for j in range(q) if np.isfinite(low[:, j]).any() or np.isfinite(high[:, j]).any()]
    precision = np.linalg.inv(cov)
    shift = np.einsum("gij,gj->gi", precision, mean)
    site_t, site_s = np.zeros((groups, q)), np.zeros((groups, q))
    for _ in range(rounds):
        before = site_t.copy(), site_s.copy()
        for j in bounded:
            now = np.linalg.inv(precision + np.einsum("gi,ij->gij", site_t, np.eye(q)))
            m = np.einsum("gij,gj->gi", now, shift + site_s)[:, j]
            v = now[:, j, j]
            t, s = 1 / v - site_t[:, j], m / v - site_s[:, j]  # the coordinate without its own factor
            t = np.maximum(t, 1e-12)
            cut_m, cut_v = cut_moments(s / t, 1 / t, low[:, j], high[:, j])
            cut_v = np.maximum(cut_v, 1e-14 / t)
            site_t[:, j], site_s[:, j] = np.maximum(1 / cut_v - t, 0.0), cut_m / cut_v - s
        change = max(float(np.max(np.abs(x - y) / (1 + np.abs(x)), initial=0.0)) for x, y in zip((site_t, site_s), before))
        if change < 1e-11:
            break
    now = np.linalg.inv(precision + np.einsum("gi,ij->gij", site_t, np.eye(q)))
    return np.clip(np.einsum("gij,gj->gi", now, shift + site_s), low, high), now
