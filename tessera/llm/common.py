"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from contextlib import contextmanager
from types import SimpleNamespace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tessera.session import Scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(edges: DataFrame, scratch: Scratch, name: str = "stars") -> DataFrame:
    """Connected components of ``edges`` (a long, b long): one row (id, root)
    per vertex that has an edge, root being the smallest id reachable.

    Alternating large-star and small-star rounds: every round is two grouped
    minima (combined before the shuffle) and two joins, written to the shared
    folder; the number of rounds grows with the logarithm of the longest path.
    Self loops and repeated edges are allowed; null ends are ignored.
    """
    cur = edges.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b")).where("a <> b")
    cur = scratch.write(cur.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-0")
    state, step = None, 0
    while True:
        found = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == state or found[0] == 0:
            break
        state = found
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        mid = scratch.write(large, f"{name}-mid-{step}")
        low = mid.groupBy("a").agg(F.min("b").alias("m"))
        moved = mid.join(low, "a")
        small = (
            moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b")))
        )
        cur = scratch.write(small.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-{step + 1}")
        scratch.drop(f"{name}-mid-{step}", f"{name}-{step}")
        step += 1
    members = cur.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return members.unionByName(cur.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """``df``, marked for broadcast when it has at most ``rows`` rows; beyond
    that the same join shuffles. ``df`` should be a written table."""
    return F.broadcast(df) if df.count() <= rows else df


def row_key():
    """A 64-bit key of a document row; rows that are equal share it."""
    return F.xxhash64("doc_id", "text")


def slices(batch: pa.RecordBatch, most_bytes: int):
    """``batch`` in order, in parts of at most ``most_bytes`` or one row."""
    if batch.num_rows < 2 or batch.nbytes <= most_bytes:
        yield batch
        return
    half = batch.num_rows // 2
    yield from slices(batch.slice(0, half), most_bytes)
    yield from slices(batch.slice(half), most_bytes)


#: Bytes of an Arrow batch that Spark fills; else 10000 rows, however long, are held several times in the executor and in Python.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def batches_of(spark: SparkSession, most_bytes: int):
    """Queries that are run inside send at most some ``most_bytes`` to Python at a time."""
    before = spark.conf.get(BATCH_BYTES, None)
    spark.conf.set(BATCH_BYTES, str(most_bytes))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_BYTES) if before is None else spark.conf.set(BATCH_BYTES, before)


def map_batches(df: DataFrame, work, schema: str, most_bytes: int = 1 << 62) -> DataFrame:
    """``mapInArrow`` with plain values, so that nullable integers stay exact.

    ``work`` gets an iterator of batches whose attributes are the columns as
    lists, and yields dicts of columns or lists of rows in schema order.
    ``most_bytes`` bounds what is held as Python values at a time, but for a
    single row beyond it.
    """
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        parts = (part for b in batches if b.num_rows for part in slices(b, most_bytes))
        plain = (SimpleNamespace(**dict(zip(b.schema.names, (c.to_pylist() for c in b.columns)))) for b in parts)
        for out in work(plain):
            if isinstance(out, list):
                out = dict(zip(kinds.names, zip(*out))) if out else {}
            columns = [pa.array(out.get(f.name, ()), f.type) for f in kinds]
            yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    return df.mapInArrow(run, schema)
