"""Column arithmetic that keeps the source semantics under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """num / den as DOUBLE, NULL where the denominator is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def r6(col: Column) -> Column:
    return F.round(col, 6)


def half_even(col: Column, digits: int) -> Column:
    return F.bround(col, digits)


def sample_variance(n: Column, total: Column, squares: Column) -> Column:
    """Variance over n values from their sum and sum of squares; implicit zeros cost nothing."""
    n = n.cast("double")
    return F.try_divide(squares - total * total / n, n - 1)


def to_micron(px: Column, spot_diameter: float, spot_micron: float = 65.0) -> Column:
    return px * F.lit(spot_micron / spot_diameter)


def value_bucket(value: Column, per_octave: int = 64) -> Column:
    """A monotone coarse code of a number.

    Values that share a code lie within a factor 2**(1/per_octave) of each other,
    and the number of codes is bounded by the exponent range of DOUBLE.
    """
    magnitude = F.floor((F.log2(F.abs(value)) + 1100) * per_octave)
    return (
        F.when(value > 0, magnitude)
        .when(value < 0, -magnitude)
        .otherwise(F.lit(0))
        .cast("long")
    )
