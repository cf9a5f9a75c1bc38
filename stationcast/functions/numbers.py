"""Rounding that follows the stored binary value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(value: Column, digits: int) -> Column:
    """Round a double to ``digits`` decimals the way Python's ``round`` does.

    ``bround`` looks at the printed decimal, so it sees 0.35 as a tie although the stored number is
    below it. Here the product with the power of ten is carried with its rounding error (a split
    product), so ties are recognised only where the binary value really is one. Valid for
    magnitudes below 1e12 and at most four digits.
    """
    if not 0 <= digits <= 4:
        raise ValueError("digits must be between 0 and 4")
    scale = float(10 ** digits)
    wide = value * F.lit(134217729.0)
    high = wide - (wide - value)
    low = value - high
    product = value * F.lit(scale)
    error = (high * scale - product) + low * scale
    base = F.floor(product).cast("double")
    # The error is smaller than one step of `product`, so this sum has the sign of the exact value.
    beyond_half = ((product - base) - 0.5) + error
    step = (F.when(beyond_half > 0, 1.0).when(beyond_half < 0, 0.0)
            .otherwise(F.pmod(base, F.lit(2.0))))
    return (base + step) / scale + 0.0


def to_fahrenheit(celsius: Column) -> Column:
    return celsius * 9 / 5 + 32
