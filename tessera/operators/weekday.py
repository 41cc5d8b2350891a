"""Weekday encoding by dimension join, and decoding of (averaged) points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.cyclic import decode_day, encode_day_number
from tessera.sources.weekday import weekday_table


def attach_weekday(df: DataFrame, name_col: str = "Vkpv") -> DataFrame:
    """Left outer join with the 7-row weekday table on the name, then drop the
    name: adds ``dow_x, dow_y`` (null for an unknown name). The dimension has
    a fixed size of 7 rows, so it is always broadcast (no shuffle of the fact
    side, no skew exposure)."""
    dim = weekday_table(df.sparkSession).withColumnRenamed("Vkpv", name_col)
    return df.join(F.broadcast(dim), on=name_col, how="left").drop(name_col)


def encode_weekday(df: DataFrame, day_col: str) -> DataFrame:
    """Same encoding from a day number 1..7 (Monday = 1), no join."""
    x, y = encode_day_number(day_col)
    return df.withColumns({"dow_x": x, "dow_y": y})


def decode_weekday(df: DataFrame, x: str = "dow_x", y: str = "dow_y", out: str = "dow") -> DataFrame:
    """Adds ``out`` in (0, 7] from a unit-circle point (Sunday = 7.0)."""
    return df.withColumn(out, decode_day(x, y))
