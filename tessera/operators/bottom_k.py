"""The k rows that come first in an order, in one job.

Every task keeps its first k rows while it streams its input; what is left of
the tasks is dealt anew and merged the same way, so no task holds more than a
few k rows of its own or takes the candidates of all tasks at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLACK = 65_536  # rows beyond 2 k that a task gathers before it selects again


def first_in_task(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """At most k rows of every task, the first in ``order`` (ascending)."""
    keys = [(c, "ascending") for c in order]

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def least() -> pa.Table:
            table = pa.Table.from_batches(held)
            return table.take(pc.select_k_unstable(table, k, keys)) if table.num_rows > k else table

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows > 2 * k + SLACK:
                held = least().combine_chunks().to_batches()
                rows = sum(b.num_rows for b in held)
        if held:
            yield from least().combine_chunks().to_batches()

    return df.mapInArrow(select, df.schema)


def bottom_k(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """The first k rows of ``df`` in ``order``, sorted. The columns of
    ``order`` must not be null, and no two rows should be equal in them."""
    return first_in_task(df, order, k).repartition(*order).orderBy(*order).limit(k)
