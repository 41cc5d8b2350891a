"""Min-max scaling expressions with a zero-range guard."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def minmax_scale(c: Column | str, lo: float, hi: float) -> Column:
    """(c - lo) / (hi - lo); a constant column (hi == lo) scales to 0.0."""
    rng = hi - lo
    if rng == 0:
        return F.when(_col(c).isNotNull(), F.lit(0.0))
    return (_col(c) - F.lit(lo)) / F.lit(rng)


def minmax_unscale(c: Column | str, lo: float, hi: float) -> Column:
    """Inverse of :func:`minmax_scale`: v * (hi - lo) + lo."""
    return _col(c) * F.lit(hi - lo) + F.lit(lo)
