"""Statistics as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part, whole) -> Column:
    """part / whole as double, null where whole is 0."""
    return F.when(whole != 0, part.cast("double") / whole.cast("double"))


def percentile(value, q: float) -> Column:
    """Exact percentile with linear interpolation; nulls don't count."""
    return F.percentile(value, F.lit(q))


def wilson(successes, total, z: float = 1.959963984540054) -> tuple[Column, Column]:
    """Bounds of the Wilson score interval, null without trials."""
    n = F.when(total > 0, total.cast("double"))
    p = successes.cast("double") / n
    d = 1 + z * z / n
    centre = (p + z * z / (2 * n)) / d
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / d
    return F.greatest(F.lit(0.0), centre - half), F.least(F.lit(1.0), centre + half)


def clamp(value, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def r6(value) -> Column:
    """Rounded to six decimals, as reports show it; -0.0 becomes 0.0."""
    return F.round(value, 6) + F.lit(0.0)
