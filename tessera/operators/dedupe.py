"""Duplicate removal that keeps first-seen order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.numbering import numbered
from tessera.session import Scratch


def first_seen(df: DataFrame, key: str | Column | Sequence[str | Column], order_col: str = "id",
               count_col: str | None = "n") -> DataFrame:
    """One row per distinct key (a column, several, or an expression — the
    "key function") with the position where it was first seen
    (``first_<order_col>``) and optionally how often it occurs.

    A grouped min, partially aggregated in every task: a key that occurs in a
    third of all rows costs one row per task in the shuffle. Order the result
    by ``first_<order_col>`` for first-seen order.
    """
    keys = [key] if isinstance(key, (str, Column)) else list(key)
    aggs = [F.min(order_col).alias(f"first_{order_col}")]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    return df.groupBy(*keys).agg(*aggs)


def seen_positions(found: DataFrame, order_col: str = "id", out: str = "position") -> DataFrame:
    """The rows of :func:`first_seen` with their places 0..n-1 in first-seen
    order (keys first seen at the same place go by their values)."""
    first = f"first_{order_col}"
    return numbered(found, [first, *[c for c in found.columns if c != first]], out, Scratch(found.sparkSession), "first-seen")
