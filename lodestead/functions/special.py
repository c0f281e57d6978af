"""Tails of distributions as column expressions: series and continued fractions with a fixed number of terms.

Meant for the few rows that a test of hypotheses ends in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Terms: enough for arguments to about a million.
TERMS = 2_000
_TINY = 1e-300


def log_gamma(a: Column) -> Column:
    """Natural logarithm of gamma for a > 0: Stirling's series, ten places further on."""
    far = a + 10
    series = 1 / (12 * far) - 1 / (360 * F.pow(far, F.lit(3.0))) + 1 / (1260 * F.pow(far, F.lit(5.0))) - 1 / (1680 * F.pow(far, F.lit(7.0)))
    steps = sum((F.log(a + k) for k in range(1, 10)), F.log(a))
    return (far - 0.5) * F.log(far) - far + 0.9189385332046727 + series - steps


def _from_zero(x: Column) -> Column:
    return F.when(F.abs(x) < _TINY, _TINY).otherwise(x)


def _named(fn, *values: Column) -> Column:
    """``fn`` of values that are worked out once."""
    packed = F.array(F.struct(*[v.cast("double").alias(f"v{i}") for i, v in enumerate(values)]))
    return F.transform(packed, lambda s: fn(*[s[f"v{i}"] for i in range(len(values))]))[0]


def _lentz(c: Column, d: Column, h: Column, step) -> Column:
    """Continued fraction by Lentz's method from its state on: ``step(i)`` gives numerator and denominator of term i."""

    def added(s: Column, i: Column) -> Column:
        over, under = step(i)
        d = 1 / _from_zero(over * s["d"] + under)
        c = _from_zero(under + over / s["c"])
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    begun = F.struct(c.alias("c"), d.alias("d"), h.alias("h"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), begun, added, lambda s: s["h"])


def gamma_tail(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma Q(a, x) for a > 0; 1 for x <= 0."""

    def tail(a: Column, x: Column) -> Column:
        scale = F.exp(a * F.log(F.greatest(x, F.lit(_TINY))) - x - log_gamma(a))
        series = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), F.struct((1 / a).alias("t"), (1 / a).alias("s")), lambda s, i: F.struct((s["t"] * x / (a + i)).alias("t"), (s["s"] + s["t"] * x / (a + i)).alias("s")), lambda s: s["s"])
        first = 1 / _from_zero(x + 1 - a)
        fraction = _lentz(F.lit(1 / _TINY), first, first, lambda i: (-i * (i - a), x + 1 - a + 2 * i))
        return F.when(x <= 0, 1.0).when(x < a + 1, 1 - scale * series).otherwise(scale * fraction)

    return _named(tail, a, x)


def beta_share(a: Column, b: Column, x: Column) -> Column:
    """Regularised incomplete beta I_x(a, b) for a, b > 0 and 0 <= x <= 1."""

    def fraction(a: Column, b: Column, x: Column) -> Column:
        def pair(i: Column) -> tuple[Column, Column]:
            m = F.floor(i / 2)
            even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            return F.when(i % 2 == 0, even).otherwise(odd), F.lit(1.0)

        return 1 / _lentz(F.lit(1.0), F.lit(0.0), F.lit(1.0), pair)

    def share(a: Column, b: Column, x: Column) -> Column:
        scale = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(F.greatest(x, F.lit(_TINY))) + b * F.log(F.greatest(1 - x, F.lit(_TINY))))
        below = x < (a + 1) / (a + b + 2)
        return F.when(x <= 0, 0.0).when(x >= 1, 1.0).when(below, scale * fraction(a, b, x) / a).otherwise(1 - scale * fraction(b, a, 1 - x) / b)

    return _named(share, a, b, x)


def chi_square_tail(x: Column, dof: Column) -> Column:
    """Chance of a chi squared of at least x."""
    return gamma_tail(dof / 2, x / 2)


def normal_tail(z: Column) -> Column:
    """Chance of a standard normal of at least z."""
    half = gamma_tail(F.lit(0.5), z * z / 2) / 2
    return F.when(z >= 0, half).otherwise(1 - half)


def student_two_sided(t: Column, dof: Column) -> Column:
    """Chance of a Student t of at least that size, either way."""
    return beta_share(dof / 2, F.lit(0.5), dof / (dof + t * t))
