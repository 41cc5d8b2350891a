"""Euclidean distances between feature columns and centroid coordinates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_distance(a: Sequence[Column], b: Sequence[Column | float]) -> Column:
    """Σ (a_i - b_i)², summed left to right (the SQL oracles use the same order)."""
    total = None
    for ai, bi in zip(a, b, strict=True):
        d = ai - (bi if isinstance(bi, Column) else F.lit(float(bi)))
        term = d * d
        total = term if total is None else total + term
    return total


def euclidean_distance(a: Sequence[Column], b: Sequence[Column | float]) -> Column:
    return F.sqrt(squared_distance(a, b))
