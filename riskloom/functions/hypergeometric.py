"""Hypergeometric probabilities to full relative precision, by saddle-point terms instead of log-gammas of large numbers.

A binomial probability is exp(-errors - deviances) times a square root, where the errors are those of Stirling's formula
and the deviances vanish at the mean: nothing large is subtracted. A hypergeometric one is a quotient of three of them.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np

# A log probability this far below another adds nothing to it in double precision, whatever the number of terms.
NEGLIGIBLE = 45.0
# Log probabilities closer than this are ties.
TIE = 1e-7


def stirling_error(n: np.ndarray) -> np.ndarray:
    """ln n! less Stirling's formula, for n >= 1."""
    n = np.asarray(n, float)
    big = np.maximum(n, 16.0)
    i2 = 1.0 / (big * big)
    series = (1 / 12 - i2 * (1 / 360 - i2 * (1 / 1260 - i2 * (1 / 1680 - i2 / 1188)))) / big
    small = np.array([0.0] + [math.lgamma(k + 1) - (k + 0.5) * math.log(k) + k - 0.5 * math.log(2 * math.pi) for k in range(1, 16)])
    return np.where(n >= 16, series, small[np.minimum(n, 15).astype(int)])


def deviance(x: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """x ln(x / mean) + mean - x for x >= 1, by a series near the mean."""
    x, mean = np.asarray(x, float), np.asarray(mean, float)
    v = (x - mean) / (x + mean)
    near = np.abs(v) < 0.1
    w = np.where(near, v, 0.0)
    total, term = (x - mean) * w, 2 * x * w
    for j in range(1, 12):
        term = term * w * w
        total = total + term / (2 * j + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(near, total, x * np.log(x / mean) + mean - x)


def log_binomial(x: np.ndarray, n: float, p: float, q: float) -> np.ndarray:
    """ln of the probability of x successes among n, for 0 < p = 1 - q < 1."""
    x = np.asarray(x, float)
    inner = np.clip(x, 1.0, max(n - 1.0, 1.0))
    rest = np.maximum(n - inner, 1.0)
    errors = stirling_error(np.array(max(n, 1.0))) - stirling_error(inner) - stirling_error(rest)
    middle = errors - deviance(inner, n * p) - deviance(rest, n * q) + 0.5 * np.log(max(n, 1.0) / (2 * math.pi * inner * rest))
    return np.where(x == 0, n * np.log1p(-p) if p < 0.5 else n * math.log(q), np.where(x == n, n * np.log1p(-q) if q < 0.5 else n * math.log(p), middle))


def log_hypergeometric(x: np.ndarray, row: int, col: int, total: int) -> np.ndarray:
    """ln of the probability of x in the corner of a table with these margins, 0 < row < total."""
    p, q = row / total, (total - row) / total
    x = np.asarray(x, float)
    return log_binomial(x, col, p, q) + log_binomial(row - x, total - col, p, q) - log_binomial(np.array(float(row)), total, p, q)


def _first(low: int, high: int, holds: Callable[[int], bool]) -> int:
    """The least number in [low, high] from which on ``holds``; high + 1 if nowhere."""
    high += 1
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if holds(middle) else (middle + 1, high)
    return low


def tail_runs(seen: int, row: int, col: int, total: int, size: int) -> list[tuple[int, int]]:
    """Runs of at most ``size`` numbers that hold all tables no likelier than the seen one, but for negligible ones.

    Probabilities rise to the mode and fall after it, so the boundaries of both tails are found by bisection.
    """
    least, most = max(0, row + col - total), min(row, col)
    if least == most:
        return [(least, most)]
    lp = lambda x: float(log_hypergeometric(np.array(x), row, col, total))
    mode = min(max((row + 1) * (col + 1) // (total + 2), least), most)
    bound = lp(seen) + TIE
    floor = bound - NEGLIGIBLE - math.log(most - least + 1)
    if lp(mode) <= bound:
        parts = [(_first(least, mode, lambda x: lp(x) >= floor), _first(mode, most, lambda x: lp(x) < floor) - 1)]
    else:
        low = _first(least, mode, lambda x: lp(x) > bound) - 1
        high = _first(mode, most, lambda x: lp(x) <= bound)
        parts = [(_first(least, low, lambda x: lp(x) >= floor), low), (high, _first(high, most, lambda x: lp(x) < floor) - 1)]
    return [(a, min(a + size - 1, end)) for start, end in parts if start <= end for a in range(start, end + 1, size)]


def run_sum(first: int, last: int, row: int, col: int, total: int) -> float:
    """Sum of the probabilities of [first, last]: one closed form, then ratios of neighbours."""
    if max(0, row + col - total) == min(row, col):
        return 1.0
    x = np.arange(first, last, dtype=float)
    ratios = np.log((col - x) * (row - x)) - np.log((x + 1) * (total - row - col + x + 1))
    start = float(log_hypergeometric(np.array(first), row, col, total))
    return float(np.exp(start + np.concatenate(([0.0], np.cumsum(ratios)))).sum())
