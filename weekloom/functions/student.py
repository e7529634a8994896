"""Two-sided Student-t p-values as a Spark column expression (no Python worker)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SIMPSON_STEPS = 512
REACH = 12.0  # beyond REACH / sqrt(df) the density is below exp(-72)


def _cos_power_integral(lo: Column, hi: Column, exponent: Column) -> Column:
    """Simpson's rule for the integral of cos(x)^exponent over [lo, hi]."""
    h = (hi - lo) / F.lit(float(SIMPSON_STEPS))

    def add(acc: Column, i: Column) -> Column:
        inner = F.when(i % 2 == 1, 4.0).otherwise(2.0)
        weight = F.when((i == 0) | (i == SIMPSON_STEPS), 1.0).otherwise(inner)
        return acc + weight * F.pow(F.cos(lo + i * h), exponent)

    steps = F.sequence(F.lit(0), F.lit(SIMPSON_STEPS))
    return F.aggregate(steps, F.lit(0.0), add) * h / F.lit(3.0)


def t_two_sided(t: Column, df: Column) -> Column:
    """P(|T| > |t|) for ``df`` degrees of freedom, from T = sqrt(df) * tan(angle).

    The angle's density is proportional to cos(angle)^(df - 1), so the p-value is the ratio
    of two smooth integrals, evaluated once per series.
    """
    top = F.least(F.lit(math.pi / 2), F.lit(REACH) / F.sqrt(df))
    start = F.least(F.atan(F.abs(t) / F.sqrt(df)), top)
    tail = _cos_power_integral(start, top, df - 1)
    whole = _cos_power_integral(F.lit(0.0), top, df - 1)
    return tail / whole
