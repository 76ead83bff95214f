"""Special functions as column expressions (built-in functions only, so they stay in the plan)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The coefficients of Stirling's series for the logarithm of the gamma function.
STIRLING = ((1, 12), (-1, 360), (1, 1260), (-1, 1680), (1, 1188), (-691, 360360))
_SHIFT = 10


def log_gamma(a: Column) -> Column:
    """ln Gamma(a) for a > 0: Stirling's series at a + 10, carried back by the recurrence."""
    z = a + _SHIFT
    series = sum((F.lit(p / q) / F.pow(z, F.lit(2.0 * k + 1)) for k, (p, q) in enumerate(STIRLING)), F.lit(0.0))
    back = sum((F.log(a + k) for k in range(_SHIFT)), F.lit(0.0))
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - back


def upper_gamma(a: Column, x: Column) -> Column:
    """The regularised upper incomplete gamma function Q(a, x), a > 0: the power series of the lower one below
    a + 1, the continued fraction (Lentz's form) from there on; steps grow with the square root of ``a``."""
    steps = F.sequence(F.lit(1), (F.lit(100) + 10 * F.sqrt(a)).cast("int"))
    scale = F.exp(a * F.log(x) - x - log_gamma(a))

    def state(**parts: Column) -> Column:
        return F.struct(*[v.alias(k) for k, v in parts.items()])

    first = 1.0 / a
    series = F.aggregate(steps, state(term=first, total=first), lambda s, n: state(
        term=s["term"] * x / (a + n), total=s["total"] + s["term"] * x / (a + n)), lambda s: s["total"])
    tiny = F.lit(1e-300)

    def nonzero(v: Column) -> Column:
        return F.when(F.abs(v) < tiny, tiny).otherwise(v)

    def step(s: Column, n: Column) -> Column:
        by, b = -n * (n - a), x + 1 - a + 2 * n
        d, c = 1.0 / nonzero(by * s["d"] + b), nonzero(b + by / s["c"])
        return state(c=c, d=d, h=s["h"] * c * d)

    start = 1.0 / nonzero(x + 1 - a)
    fraction = F.aggregate(steps, state(c=F.lit(1e300), d=start, h=start), step, lambda s: s["h"])
    q = F.when(x < a + 1, 1.0 - scale * series).otherwise(scale * fraction)
    return F.when(x <= 0, 1.0).otherwise(F.least(F.greatest(q, F.lit(0.0)), F.lit(1.0)))


def chi_square_tail(statistic: Column, degrees_of_freedom: Column) -> Column:
    """P(X >= statistic) of the chi-square distribution; 1 without degrees of freedom."""
    a = degrees_of_freedom.cast("double") / 2
    return F.when(degrees_of_freedom <= 0, 1.0).otherwise(upper_gamma(F.greatest(a, F.lit(0.5)), statistic / 2))
