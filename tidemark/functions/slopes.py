"""The median of all pairwise slopes of a series without making the pairs: slope selection by counting inversions.

A pair of points has a slope of at most m exactly where its values of y - m x stand in the wrong order, so the number of such
pairs is a count of inversions, which a sort gives. Halving the interval of slopes with that count finds the slope of a
given rank. Equal and opposite signs are counted on the y themselves, so a median of zero is exactly zero.
"""

from __future__ import annotations

import numpy as np

SHORT = 400  # up to so many points all slopes are made: fewer than 80,000, quicker than counting
_SIGN = np.int64(-(2**63))


def inversions(rank: np.ndarray) -> int:
    """Pairs in the wrong order in a permutation, by one stable partition a bit."""
    n, total = len(rank), 0
    order = rank
    for b in range(int(n - 1).bit_length() - 1, -1, -1):
        one = order >> b & 1
        group = order >> (b + 1)
        before = np.cumsum(one) - one
        start = np.concatenate([[True], group[1:] != group[:-1]])
        before = before - np.repeat(before[start], np.diff(np.concatenate([np.flatnonzero(start), [n]])))
        total += int(before[one == 0].sum())
        order = order[np.argsort(order >> b, kind="stable")]
    return total


def not_above(x: np.ndarray, y: np.ndarray, m: float) -> int:
    """Pairs with a slope of at most ``m``; ``x`` ascending."""
    z = y - m * x
    n = len(z)
    rank = np.empty(n, np.int64)
    rank[np.lexsort((-np.arange(n), z))] = np.arange(n)  # of equal values the later one first: they count
    return inversions(rank)


def _ordered(v: float) -> int:
    """Doubles as integers in the same order."""
    i = int(np.float64(v).view(np.int64))
    return i if i >= 0 else int(_SIGN) - i


def _double(i: int) -> float:
    return float(np.int64(i if i >= 0 else int(_SIGN) - i).view(np.float64))


def slope_of_rank(x: np.ndarray, y: np.ndarray, rank: int) -> float:
    """The slope with ``rank`` (from 0) pairs before it, to the last bits of a double; exactly 0.0 where it is zero."""
    below_or_zero, n = not_above(np.arange(len(y), dtype=float), y, 0.0), len(x)
    below = n * (n - 1) // 2 - not_above(np.arange(n, dtype=float), -y, 0.0)
    if below <= rank < below_or_zero:
        return 0.0
    step = np.diff(y) / np.diff(x)  # every slope lies between the least and the greatest of neighbours
    if rank < below:
        lo, hi = _ordered(float(step.min())), _ordered(-0.0) - 1
    else:
        lo, hi = 1, _ordered(float(step.max()))
    lo, hi = lo - 4, hi + 4
    while lo < hi:
        mid = (lo + hi) // 2
        if not_above(x, y, _double(mid)) > rank:
            hi = mid
        else:
            lo = mid + 1
    return _double(lo)


def median_slope(x: np.ndarray, y: np.ndarray) -> float | None:
    """Median of the slopes of all pairs; the mean of the middle two where their number is even."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    n = len(x)
    if n < 2:
        return None
    if n <= SHORT:
        i, j = np.triu_indices(n, 1)
        return float(np.median((y[j] - y[i]) / (x[j] - x[i])))
    pairs = n * (n - 1) // 2
    middle = {(pairs - 1) // 2, pairs // 2}
    return float(np.mean([slope_of_rank(x, y, r) for r in middle]))
