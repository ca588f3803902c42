"""Tail probabilities of test statistics; called on a handful of result rows, never on data rows."""

from __future__ import annotations

import math

import numpy as np


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def chi_square_upper(x: float, dof: int) -> float:
    """P(chi-square >= x): the upper incomplete gamma function, by its series below the mean and its continued fraction above.

    Both need about sqrt(dof) steps near the mean and fewer elsewhere.
    """
    if dof <= 0 or x <= 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    half, shape = x / 2.0, dof / 2.0
    scale = math.exp(shape * math.log(half) - half - math.lgamma(shape))
    if half < shape + 1:
        term = total = 1.0 / shape
        k = shape
        while term > total * 1e-17:
            k += 1
            term *= half / k
            total += term
        return min(1.0, max(0.0, 1.0 - scale * total))
    # Lentz's evaluation of the continued fraction
    b = half + 1 - shape
    c, d = 1e300, 1.0 / b
    value, i = d, 0
    while True:
        i += 1
        a = i * (shape - i)
        b += 2
        d = 1.0 / ((a * d + b) or 1e-300)
        c = (b + a / c) or 1e-300
        value *= c * d
        if abs(c * d - 1) < 1e-14:
            return min(1.0, max(0.0, scale * value))


def ks_exact(distance: float, m: int, n: int) -> float:
    """Exact two-sided probability of a two-sample distance at least this large.

    Walk all merged orders of the two samples diagonal by diagonal and carry the share of walks that have
    reached the distance; a whole diagonal is one vector step.
    """
    if distance <= 0:
        return 1.0
    edge = distance - 1e-9 / max(m, n)
    hit = np.zeros(m + 1)
    i = np.arange(m + 1)
    for s in range(1, m + n + 1):
        j = s - i
        grown = np.zeros(m + 1)
        grown[1:] = hit[:-1] * (i[1:] / s)
        grown += hit * (np.clip(j, 0, None) / s)
        valid = (j >= 0) & (j <= n)
        grown[~valid] = 0.0
        outside = valid & (np.abs(i / m - j / n) >= edge)
        grown[outside] = 1.0
        hit = grown
    return float(min(1.0, max(0.0, hit[m])))


def ks_limit(distance: float, m: int, n: int) -> float:
    """Limiting two-sided probability (Kolmogorov's series) for large samples."""
    t = distance * math.sqrt(m * n / (m + n))
    if t <= 0:
        return 1.0
    if t < 0.3:
        # the alternating series converges slowly here; its dual form does not
        total = sum(math.exp(-((2 * k - 1) ** 2) * math.pi**2 / (8 * t * t)) for k in range(1, 20))
        return min(1.0, max(0.0, 1.0 - math.sqrt(2 * math.pi) / t * total))
    total = sum((-1) ** (k - 1) * math.exp(-2 * k * k * t * t) for k in range(1, 101))
    return min(1.0, max(0.0, 2 * total))


def ks_two_sided(distance: float, m: int, n: int, method: str = "limit") -> float:
    """Probability by the limiting series or, on request, by the exact count, whose work grows with m * (m + n)."""
    if method not in ("limit", "exact"):
        raise ValueError(f"unknown method {method!r}; known: limit, exact")
    if m == 0 or n == 0:
        return math.nan
    return ks_exact(distance, m, n) if method == "exact" else ks_limit(distance, m, n)
