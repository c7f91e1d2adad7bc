"""Two-sided p-value of a t statistic, as an expression for the few rows that a test ends in."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_SHIFT = 20


def _log_gamma_step(a: Column) -> Column:
    """ln gamma(a + 1/2) - ln gamma(a), by its series at a + 20, carried down to a."""
    high = a + _SHIFT
    series = (
        F.ln(high) / 2
        - 1 / (8 * high)
        + 1 / (192 * F.pow(high, F.lit(3)))
        - 1 / (640 * F.pow(high, F.lit(5)))
        + 17 / (14336 * F.pow(high, F.lit(7)))
    )
    steps = F.sequence(F.lit(0), F.lit(_SHIFT - 1))
    return series + F.aggregate(
        steps, F.lit(0.0), lambda total, i: total + F.ln((a + i) / (a + i + 0.5))
    )


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta function, from the back.

    The depth that is needed grows with the root of the larger parameter.
    """
    depth = (200 + 4 * F.sqrt(F.greatest(a, b))).cast("int")

    def step(value: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m - 1) * (a + b + m - 1) * x / ((a + 2 * m - 2) * (a + 2 * m - 1))
        return 1 + odd / (1 + even / value)

    return F.aggregate(F.sequence(depth, F.lit(1)), F.lit(1.0), step)


def two_sided_p(t: Column, df: Column) -> Column:
    """P(|T| >= |t|): the incomplete beta function at df / (df + t^2) with df / 2 and 1 / 2."""
    t, df = t.cast("double"), df.cast("double")
    a, half = df / 2, F.lit(0.5)
    square = t * t
    x, rest = df / (df + square), square / (df + square)
    front = F.exp(
        _log_gamma_step(a)
        - 0.5 * math.log(math.pi)
        - a * F.log1p(square / df)
        + 0.5 * F.ln(rest)
    )
    near = x >= (a + 1) / (a + 2.5)
    tail = front / (a * _fraction(a, half, x))
    centre = 1 - front / (half * _fraction(half, a, rest))
    return F.when(square == 0, 1.0).when((df > 0) & near, centre).when(df > 0, tail)
