"""Rounding and ratios that agree with IEEE doubles bit for bit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0  # 2**27 + 1, splits a double into two halves


def ratio(num: Column, den: Column) -> Column:
    """``num / den``, 0.0 where the denominator is not positive."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def round_exact(col: Column, digits: int) -> Column:
    """Round the binary value of a double half to even.

    ``round`` works on the decimal text of a double and so takes 0.285 up
    although its binary value is below the tie. Here the product with
    ``10**digits`` is formed with its rounding error (Dekker's split), and the
    error decides ties. Right for magnitudes below ``2**52 / 10**digits``.
    """
    scale = float(10**digits)
    c = _SPLIT * scale
    scale_hi = c - (c - scale)
    scale_lo = scale - scale_hi
    x = F.abs(col.cast("double"))
    product = x * F.lit(scale)
    x_c = x * F.lit(_SPLIT)
    x_hi = x_c - (x_c - x)
    x_lo = x - x_hi
    err = ((x_hi * scale_hi - product) + x_hi * scale_lo + x_lo * scale_hi) + x_lo * scale_lo
    whole = F.floor(product).cast("double")
    over = (product - whole - F.lit(0.5)) + err
    odd = F.pmod(whole, F.lit(2.0)) == 1.0
    up = F.when(over > 0, F.lit(1.0)).when((over == 0) & odd, F.lit(1.0)).otherwise(F.lit(0.0))
    rounded = (whole + up) / F.lit(scale)
    return F.when(F.isnan(col) | (x >= F.lit(2.0**52 / scale)), col).otherwise(
        F.when(col < 0, -rounded).otherwise(rounded)
    )


def to_double(text: Column) -> Column:
    """Number text to double, null where it is no plain number.

    The guard refuses type suffixes such as ``0.9f`` that a cast accepts.
    """
    number = r"^[+-]?((\d+(_\d+)*)?\.?\d+(_\d+)*|\d+(_\d+)*\.)([eE][+-]?\d+)?$"
    special = r"(?i)^[+-]?(inf|infinity|nan)$"
    plain = F.regexp_replace(text, "_", "")
    return (
        F.when(text.rlike(number), plain.try_cast("double"))
        .when(F.lower(text).rlike(r"^[+-]?nan$"), F.lit(float("nan")))
        .when(text.rlike(special) & text.startswith("-"), F.lit(float("-inf")))
        .when(text.rlike(special), F.lit(float("inf")))
    )
