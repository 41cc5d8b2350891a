"""Bounded previews (the console peeks of the batch jobs)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def preview(df: DataFrame, n: int = 10, order_by: str = "id") -> DataFrame:
    """First ``n`` rows in a stable order (TakeOrderedAndProject: top-n per task)."""
    return df.orderBy(order_by).limit(n)
