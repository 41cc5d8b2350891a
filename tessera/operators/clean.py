"""Dirty-row handling: one policy for every path — a row is dropped when any
feature is null, NaN or blank text; the rejects are counted, never hidden."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _present(df: DataFrame, c: str) -> Column:
    """Explicit IS NOT NULL (pushed into the parquet scan, unlike na.drop)."""
    cond, kind = F.col(c).isNotNull(), df.schema[c].dataType
    if isinstance(kind, T.StringType):
        cond = cond & (F.length(F.trim(F.col(c))) > 0)
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        cond = cond & ~F.isnan(c)
    return cond


def complete_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows where every column in ``cols`` is present."""
    cond = None
    for c in cols:
        p = _present(df, c)
        cond = p if cond is None else cond & p
    return df if cond is None else df.filter(cond)


def reject_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: total, kept, rejected, and rows missing each column (one pass,
    partial aggregation in every task)."""
    keep = None
    for c in cols:
        p = F.coalesce(_present(df, c), F.lit(False))
        keep = p if keep is None else keep & p
    aggs = [F.count(F.lit(1)).alias("n_rows"),
            F.count_if(keep).alias("n_clean"),
            F.count_if(~keep).alias("n_rejected")]
    aggs += [F.count_if(~F.coalesce(_present(df, c), F.lit(False))).alias(f"missing_{c}") for c in cols]
    return df.agg(*aggs)
