"""Exact half-up rounding to two decimals for ratios of non-negative integers.

``round(double, 2)`` depends on the binary value of the double (1.005 is stored
below 1.005); doing the rounding in integer arithmetic gives the decimal
answer, the one a database computes on exact numerics. Integer division and
decimals keep it exact for every bigint:

    round(num / den, 2) = ((200 * num + den) div (2 * den)) / 100
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Wide enough for every bigint; products below stay within 38 digits.
_WHOLE = "decimal(19,0)"


def _ratio_2dp(num: Column, den: Column, scale: int) -> Column:
    den = F.nullif(den.cast(_WHOLE), F.lit(0).cast(_WHOLE))
    top = F.lit(2 * scale).cast("decimal(6,0)") * num.cast(_WHOLE) + den
    return F.call_function("div", top, F.lit(2).cast("decimal(1,0)") * den) / F.lit(100.0)


def exact_mean_2dp(total: Column, count: Column) -> Column:
    """round(total / count, 2), half-up, for total >= 0 and count > 0."""
    return _ratio_2dp(total, count, 100)


def exact_pct_2dp(part: Column, count: Column) -> Column:
    """round(100 * part / count, 2), half-up, for part >= 0 and count > 0."""
    return _ratio_2dp(part, count, 10000)
