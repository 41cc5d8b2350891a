"""Small driver-side tables (≤ k rows) built as JVM literals.

``spark.createDataFrame`` on a Python list plans a Python RDD scan, so every
job touching it (even a broadcast of 7 rows) starts Python workers. A SQL
``VALUES`` list is parsed once in the JVM into a LocalRelation: no scan job,
no Python, exact values (doubles are written with their round-trip repr and
the ``D`` suffix).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return f"{v}L"
    if isinstance(v, float):
        if math.isnan(v) or math.isinf(v):
            return f"CAST('{v!r}' AS DOUBLE)".replace("'inf'", "'Infinity'").replace("'-inf'", "'-Infinity'")
        return f"{v!r}D"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    raise TypeError(f"unsupported literal {v!r}")


def literal_table(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType) -> DataFrame:
    fields = schema.fields
    names = [f"c{i}" for i in range(len(fields))]
    select = ", ".join(f"CAST({n} AS {f.dataType.simpleString()}) AS `{f.name}`" for n, f in zip(names, fields))
    if not rows:
        nulls = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in fields)
        return spark.sql(f"SELECT {nulls} WHERE FALSE")
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT {select} FROM VALUES {values} AS t({', '.join(names)})")
