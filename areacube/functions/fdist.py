"""Upper tail of the F distribution (UDF4) as a Column expression.

Spark has no F or incomplete-beta function.  ``P(F(d1, d2) > f)`` is
``I_x(d2/2, d1/2)`` with ``x = d2 / (d2 + d1 f)``, the regularized incomplete
beta function, evaluated by its continued fraction (modified Lentz) and the
symmetry ``I_x(a, b) = 1 - I_{1-x}(b, a)``.  The fraction is one higher-order
``aggregate`` over the numbers of its terms, the gamma functions are a
Stirling series: nothing leaves the JVM.

The fraction needs about sqrt(max(d1, d2)) terms where it is used; that many
times ``ROOTS`` are offered, terms after convergence cost one comparison, and
a value that does not converge is an error.  The difference of log-gammas is
formed directly, so large ``d2`` lose no digits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPS = 1e-15
_TINY = 1e-300
#: Terms offered: ROOTS * sqrt(max(a, b)) + LEAST.
ROOTS, LEAST = 8, 200
#: Steps by which a gamma function's argument is raised before its series is used.
SHIFT = 10


def _stirling(x: Column) -> Column:
    """log Gamma(x) - ((x - 1/2) log x - x + log(2 pi)/2), for x of SHIFT or more (to 1e-15)."""
    # The coefficients of the Stirling series.
    coefficients = [1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360]
    u = F.lit(1.0) / (x * x)
    total = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        total = total * u + F.lit(c)
    return total / x


def log_gamma(x: Column) -> Column:
    """log Gamma(x) for x > 0."""
    y = x + F.lit(float(SHIFT))
    steps = sum((F.log(x + F.lit(float(i))) for i in range(1, SHIFT)), F.log(x))
    return (y - 0.5) * F.log(y) - y + F.lit(0.5 * math.log(2 * math.pi)) + _stirling(y) - steps


def log_gamma_step(p: Column, q: Column) -> Column:
    """log Gamma(p + q) - log Gamma(p) for p, q > 0, without the cancellation of two large logarithms."""
    y = p + F.lit(float(SHIFT))
    steps = sum((F.log1p(q / (p + F.lit(float(i)))) for i in range(1, SHIFT)), F.log1p(q / p))
    return q * F.log(y + q) + (y - 0.5) * F.log1p(q / y) - q + _stirling(y + q) - _stirling(y) - steps


def _guarded(x: Column) -> Column:
    return F.when(F.abs(x) < _TINY, F.lit(_TINY)).otherwise(x)


def beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function for x < (a + 1) / (a + b + 2)."""
    top = (F.lit(ROOTS) * F.ceil(F.sqrt(F.greatest(a, b))) + LEAST).cast("int")

    def step(acc: Column, j: Column) -> Column:
        m = F.floor(j / 2).cast("double")
        at = a + F.lit(2.0) * m
        odd = -(a + m) * (a + b + m) * x / (at * (at + 1.0))
        even = m * (b - m) * x / ((at - 1.0) * at)
        coefficient = F.when(j % 2 == 1, odd).otherwise(even)
        d = F.lit(1.0) / _guarded(F.lit(1.0) + coefficient * acc["d"])
        c = _guarded(F.lit(1.0) + coefficient / acc["c"])
        return F.when(acc["done"], acc).otherwise(F.struct(
            c.alias("c"), d.alias("d"), (acc["h"] * d * c).alias("h"),
            ((j % 2 == 1) & (j > 1) & (F.abs(d * c - 1.0) <= _EPS)).alias("done")))

    start = F.struct(F.lit(1.0 / _TINY).alias("c"), F.lit(1.0).alias("d"), F.lit(1.0).alias("h"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), top), start, step,
                       lambda acc: F.when(acc["done"], acc["h"]).otherwise(F.raise_error(F.lit("F tail: no convergence")).cast("double")))


def f_upper(f: Column, d1: Column, d2: Column) -> Column:
    """``P(F(d1, d2) > f)``; NULL where an input is NULL, NaN or infinite, f < 0, or a degree of freedom is not positive."""
    f, d1, d2 = (c.cast("double") for c in (f, d1, d2))
    inf = F.lit(float("inf"))
    fine = (f >= 0) & (f < inf) & (d1 > 0) & (d1 < inf) & (d2 > 0) & (d2 < inf)         # NaN is larger than inf in Spark
    a, b, t = d2 / 2.0, d1 / 2.0, F.try_divide(d1 * f, d2)
    x, y = F.lit(1.0) / (t + 1.0), t / (t + 1.0)
    direct = x < (a + 1.0) / (a + b + 2.0)

    def pick(u: Column, v: Column) -> Column:
        return F.when(direct, u).otherwise(v)
    # named once: a lambda evaluates an expression of the row anew at every mention
    row = F.struct(a.alias("a"), b.alias("b"), t.alias("t"), direct.alias("direct"),
                   pick(a, b).alias("u"), pick(b, a).alias("v"), pick(x, y).alias("z"))

    def tail(r: Column) -> Column:
        p, q = F.greatest(r["a"], r["b"]), F.least(r["a"], r["b"])
        front = F.exp(log_gamma_step(p, q) - log_gamma(q) - (r["a"] + r["b"]) * F.log1p(r["t"]) + r["b"] * F.log(r["t"]))
        part = front * beta_fraction(r["u"], r["v"], r["z"]) / r["u"]
        return F.transform(F.array(F.struct(part.alias("part"), r["direct"].alias("direct"))),
                           lambda s: F.when(s["direct"], s["part"]).otherwise(F.lit(1.0) - s["part"]))[0]
    return F.when(fine & (t == 0), F.lit(1.0)).when(fine, F.transform(F.array(row), tail)[0])
