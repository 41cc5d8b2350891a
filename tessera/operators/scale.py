"""Global extremes and min-max scaling.

The extremes are one aggregate (partial per task, one final row), fetched
with a single action: 2 x (number of features) numbers reach the driver and
come back as literals, so the scaled plan stays a narrow projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.scaling import minmax_scale, minmax_unscale


def extremes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row ``min_<c>, max_<c>`` for every column (lazy)."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.agg(*aggs)


@dataclass(frozen=True)
class MinMax:
    """Per-column (min, max); each column keeps its own range."""

    bounds: Mapping[str, tuple[float, float]]

    def lo(self, c: str) -> float:
        return self.bounds[c][0]

    def hi(self, c: str) -> float:
        return self.bounds[c][1]

    def range(self, c: str) -> float:
        return self.hi(c) - self.lo(c)


def fit_minmax(df: DataFrame, cols: Sequence[str]) -> MinMax:
    """Collect the extremes (one job, one row). Empty input -> zero ranges."""
    row = extremes(df, cols).first()
    bounds = {}
    for c in cols:
        lo, hi = row[f"min_{c}"], row[f"max_{c}"]
        bounds[c] = (0.0, 0.0) if lo is None else (float(lo), float(hi))
    return MinMax(bounds)


def scale(df: DataFrame, mm: MinMax, cols: Sequence[str] | None = None, suffix: str = "_scaled") -> DataFrame:
    """Adds ``<c><suffix>`` = (c - min) / (max - min), 0.0 for a constant column."""
    cols = list(mm.bounds) if cols is None else cols
    return df.withColumns({f"{c}{suffix}": minmax_scale(c, mm.lo(c), mm.hi(c)) for c in cols})


def unscale(df: DataFrame, mm: MinMax, mapping: Mapping[str, str]) -> DataFrame:
    """``mapping`` scaled column -> output name, using the original column's range.

    The scaled column is looked up in ``mm`` by the name with a ``_scaled``
    suffix removed, so ``{"X_scaled": "x"}`` unscales with X's range.
    """
    out = {}
    for scaled_col, name in mapping.items():
        base = scaled_col[: -len("_scaled")] if scaled_col.endswith("_scaled") else scaled_col
        out[name] = minmax_unscale(scaled_col, mm.lo(base), mm.hi(base))
    return df.withColumns(out)
