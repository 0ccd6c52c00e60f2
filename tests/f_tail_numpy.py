"""The F distribution's upper tail in numpy, independent of the library's column form (tests only)."""

import math

import numpy as np


def _fraction(a, b, x, max_terms=1_000_000):
    """Continued fraction of the incomplete beta function, from the back: terms are doubled until it stands still."""
    n, last = 64, None
    while n <= max_terms:
        value = 1.0
        for j in range(n, 0, -1):
            m = j // 2
            if j % 2:
                coef = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            else:
                coef = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            value = 1.0 + coef / value
        if last is not None and abs(value - last) <= 1e-15 * abs(value):
            return 1.0 / value
        n, last = 2 * n, value
    raise ArithmeticError("no convergence")


def _one(f, d1, d2):
    if not (math.isfinite(f) and f >= 0 and d1 > 0 and d2 > 0):
        return math.nan
    if f == 0:
        return 1.0
    a, b = d2 / 2.0, d1 / 2.0
    x, y = d2 / (d2 + d1 * f), d1 * f / (d2 + d1 * f)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) - a * math.log1p(d1 * f / d2) + b * math.log(y))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _fraction(a, b, x) / a
    return 1.0 - front * _fraction(b, a, y) / b


def f_upper_tail(f, d1, d2):
    """``P(F(d1, d2) > f)`` for arrays; NaN where an input is missing or invalid."""
    f, d1, d2 = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (f, d1, d2)))
    return np.array([_one(*v) for v in zip(f.ravel(), d1.ravel(), d2.ravel())]).reshape(f.shape)
