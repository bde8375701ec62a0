"""Rounding of the exact binary value, halves to even: 2.675 is a little less than that and gives 2.67."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Splits a double into two halves of its digits: 2**27 + 1.
SPLIT = 134_217_729.0
#: From here on doubles are whole numbers.
WHOLE = 2.0**52


def _halves(x: Column) -> tuple[Column, Column]:
    high = x * SPLIT - (x * SPLIT - x)
    return high, x - high


def round_half_even(value: Column, digits: int = 0) -> Column:
    """``value`` (double) to ``digits`` decimals, 0 to 22, as the nearest decimal of its exact binary value; ties to even.

    The scaled value is the product p = |x| 10**digits, rounded to a double, and that rounding's error e, which
    is a double too and can be computed without loss. p's distance from the half between two whole numbers decides, and where
    it is zero, e. Values whose scaled form is whole already, null, NaN and infinite ones stay.
    """
    x, scale = F.abs(value.cast("double")), float(10**digits)
    p = x * scale
    (a, b), (c, d) = _halves(x), _halves(F.lit(scale))
    e = ((a * c - p) + a * d + b * c) + b * d
    down = F.floor(p).cast("double")
    half = (p - down) - 0.5
    up = F.when(half != 0, half > 0).when(e != 0, e > 0).otherwise(down % 2 == 1)
    near = (down + F.when(up, 1.0).otherwise(0.0)) / scale
    return F.when(p < WHOLE, F.when(value < 0, -near).otherwise(near)).otherwise(value.cast("double"))
