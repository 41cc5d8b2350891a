"""Dense numbers in an order, without a window over one partition."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import Scratch
from tessera.sources.local import literal_table

ROW_BITS = 33  # of a monotonically increasing id: the row's place in its partition


def numbered(df: DataFrame, order: Sequence, out: str, scratch: Scratch, name: str = "numbered") -> DataFrame:
    """``df`` with its rows' places 0..n-1 in ``order`` (ascending; rows equal
    there are numbered in no set order), as a written table.

    Rows are range-partitioned and sorted; a row's number is its place in its
    partition plus the rows of the partitions before, of which there is one
    count a partition.
    """
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.withColumn("_part", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
    rows = scratch.write(rows, name)
    counts = sorted((r["_part"], r["count"]) for r in rows.groupBy("_part").count().collect())
    before = [0, *accumulate(n for _, n in counts)]
    schema = T.StructType([T.StructField("_part", T.IntegerType()), T.StructField("_before", T.LongType())])
    offsets = literal_table(df.sparkSession, [(p, b) for (p, _), b in zip(counts, before)], schema)
    return rows.join(F.broadcast(offsets), "_part").withColumn(out, F.col("_place") + F.col("_before")).drop("_part", "_place", "_before")
