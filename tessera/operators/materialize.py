"""Reuse of an input across the passes of an iterative job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame

from tessera.session import shared_dir

ROWS_PER_PARTITION = 1_000_000
LEAST_PARTITIONS = 8


def for_reuse(df: DataFrame, how: str = "cache", key: str = "id", parts: int | None = None, laid_out: bool = True,
              near: Sequence[Column] = ()) -> DataFrame:
    """Materialise ``df`` for many passes, laid out by ``key``.

    The rows are hashed on ``key`` into ``parts`` partitions and sorted there,
    so order-sensitive steps (MLlib's random draws, floating sums) see the
    same rows in the same places on any cluster. Without ``parts`` their
    number follows the row count alone, never the cores. With ``laid_out``
    false the rows stay as they are, for steps that no order changes. ``near``
    sorts before ``key``, so that rows alike in it follow each other.

    ``cache``: persist MEMORY_AND_DISK; a lost executor's blocks are rebuilt
    from the (short) lineage. ``checkpoint``: write to the cluster's shared
    checkpoint folder, cutting lineage (for long upstream plans).
    """
    if laid_out:
        if parts is None:
            parts = max(LEAST_PARTITIONS, -(-df.count() // ROWS_PER_PARTITION))
        df = df.repartition(parts, key).sortWithinPartitions(*near, key)
    if how == "checkpoint":
        shared_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def release(df: DataFrame) -> None:
    if df.is_cached:
        df.unpersist()
