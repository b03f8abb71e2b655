"""Decimal rounding of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Closer to a tie than this, or larger than LARGEST after scaling, plain arithmetic could round differently.
TIE_MARGIN = 1e-3
LARGEST = 1e12


def round_half_up(value: Column, places: int = 2) -> Column:
    """Same result as `round` (half up on the shortest decimal form), without a BigDecimal per row.

    Away from ties, scaling, flooring and one correctly rounded division give the same double. Values near
    a tie, very large ones, infinities and NaN go through `round` itself.
    """
    scale = F.lit(float(10**places))
    scaled = value * scale
    nearest = F.floor(scaled + F.lit(0.5))
    off_tie = F.abs(F.abs(scaled - nearest) - F.lit(0.5)) > F.lit(TIE_MARGIN)
    plain = (F.abs(scaled) < F.lit(LARGEST)) & off_tie
    return F.when(plain, nearest / scale).otherwise(F.round(value, places))
