"""Distribution functions in numpy, for use inside vectorized functions."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np

_erfc = np.vectorize(math.erfc, otypes=[float])
_lgamma = np.vectorize(math.lgamma, otypes=[float])


def normal_tail(z: np.ndarray) -> np.ndarray:
    """P(Z >= z) of the standard normal."""
    return 0.5 * _erfc(np.asarray(z, float) / math.sqrt(2))


def normal_cdf(z: np.ndarray) -> np.ndarray:
    return normal_tail(-np.asarray(z, float))


@lru_cache(maxsize=256)
def _rank_counts(n: int, m: int) -> tuple[int, ...]:
    """How many orders of n and m values give each U, from 0 to n m."""
    counts = [1] + [0] * (n * m)
    for k in range(1, n + 1):  # multiply by (1 - q^(m + k)) / (1 - q^k)
        for i in range(n * m, m + k - 1, -1):
            counts[i] -= counts[i - m - k]
        for i in range(k, n * m + 1):
            counts[i] += counts[i - k]
    return tuple(counts)


def exact_rank_p(n: int, m: int, u: float) -> float:
    """Two-sided exact p of the rank-sum statistic without ties."""
    counts = _rank_counts(min(n, m), max(n, m))
    upper = int(max(u, n * m - u))
    return min(1.0, 2 * sum(counts[upper:]) / sum(counts))


def beta_inc(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function by Lentz's continued fraction."""
    a, b, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(b, float), np.asarray(x, float))
    turned = x > (a + 1) / (a + b + 2)
    p, q, y = np.where(turned, b, a), np.where(turned, a, b), np.where(turned, 1 - x, x)
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(_lgamma(p + q) - _lgamma(p) - _lgamma(q) + p * np.log(y) + q * np.log1p(-y)) / p
    tiny = 1e-300
    c, d = np.ones_like(y), 1 - (p + q) * y / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    out = d.copy()
    for m in range(1, 300):
        for term in (m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))):
            d = 1 + term * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + term / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            out = out * c * d
        if np.all(np.abs(c * d - 1) < 1e-15):
            break
    found = np.where((y <= 0), 0.0, front * out)
    return np.clip(np.where(turned, 1 - found, found), 0.0, 1.0)


def beta_inc_inv(a: np.ndarray, b: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The x whose regularised incomplete beta is p, by bisection to double precision."""
    a, b, p = np.broadcast_arrays(np.asarray(a, float), np.asarray(b, float), np.asarray(p, float))
    low, high = np.zeros(p.shape), np.ones(p.shape)
    for _ in range(60):
        mid = (low + high) / 2
        below = beta_inc(a, b, mid) < p
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return (low + high) / 2


def t_cdf(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Student's t distribution function."""
    t, df = np.broadcast_arrays(np.asarray(t, float), np.asarray(df, float))
    tail = beta_inc(df / 2, 0.5, df / (df + t * t)) / 2
    return np.where(t > 0, 1 - tail, tail)


def nbinom_cdf(k: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """P(X <= k) failures before n successes of probability p."""
    k = np.floor(np.asarray(k, float))
    return np.where(k < 0, 0.0, beta_inc(n, np.maximum(k, 0) + 1, p))


def normal_quantile(p: np.ndarray) -> np.ndarray:
    """Inverse of the standard normal distribution function, by bisection."""
    p = np.asarray(p, float)
    low, high = np.full(p.shape, -40.0), np.full(p.shape, 40.0)
    for _ in range(80):
        mid = (low + high) / 2
        below = normal_cdf(mid) < p
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return (low + high) / 2
