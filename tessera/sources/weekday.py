"""The seven-row weekday dimension (name -> unit-circle point)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tessera.functions.cyclic import DAY_POINTS, WEEKDAY_NAMES
from tessera.sources.local import literal_table

WEEKDAY_SCHEMA = T.StructType([
    T.StructField("Vkpv", T.StringType(), True),
    T.StructField("dow_x", T.DoubleType(), True),
    T.StructField("dow_y", T.DoubleType(), True),
])


def weekday_rows() -> list[tuple[str, float, float]]:
    return [(name, p[0], p[1]) for name, p in zip(WEEKDAY_NAMES, DAY_POINTS)]


def weekday_table(spark: SparkSession) -> DataFrame:
    """In-memory literal table, 7 rows (JVM literals: no scan, no Python)."""
    return literal_table(spark, weekday_rows(), WEEKDAY_SCHEMA)
