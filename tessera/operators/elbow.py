"""Elbow curves: clustering cost as a function of k."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.scaling import minmax_scale
from tessera.operators.cost import sum_distance_to_mean
from tessera.operators.kmeans_ml import assemble, fit_kmeans, fit_facts
from tessera.operators.lloyd import lloyd_sweep
from tessera.operators.materialize import for_reuse, release
from tessera.operators.scale import fit_minmax
from tessera.sources.local import literal_table

DEFAULT_KS = tuple(range(2, 303, 10))  # 2, 12, ..., 302

ELBOW_SCHEMA = T.StructType([
    T.StructField("NumOfCluster", T.IntegerType(), False),
    T.StructField("Cost", T.DoubleType(), True),
    T.StructField("metric", T.StringType(), False),
])

# Rows of all fits at a time: each fit holds its vectors, some 130 bytes a row.
HELD_ROWS = 24_000_000

# Cells of the features' ranges, about, by which the rows of a partition are sorted.
CELLS = 4096


FACTS_SCHEMA = T.StructType(ELBOW_SCHEMA.fields + [
    T.StructField("n_rows", T.LongType(), False),
    T.StructField("n_assigned", T.LongType(), False),
    T.StructField("n_off_nearest", T.LongType(), False),
    T.StructField("within_k", T.BooleanType(), False),
    T.StructField("cost_again", T.DoubleType(), True),
])


def by_place(df: DataFrame, features: Sequence[str]) -> list[Column]:
    """Sort columns that bring rows of one region together: the cell of a grid
    over the features' ranges, then the norm.

    MLlib skips centres by norms and by distances between centres. Neighbours
    skip the same ones, so that the processor foresees most of these tests."""
    mm, side = fit_minmax(df, features), max(2, round(CELLS ** (1 / len(features))))
    cells = [F.floor(minmax_scale(f, mm.lo(f), mm.hi(f)) * side) for f in features]
    return cells + [sum((F.col(f) * F.col(f) for f in features), F.lit(0.0))]


def elbow_kmeans(df: DataFrame, features: Sequence[str], ks: Sequence[int] = DEFAULT_KS,
                 seed: int = 1, concurrent_fits: int = 4, id_col: str = "id", facts: bool = False) -> DataFrame:
    """MLlib k-means for every k on one persisted feature table; cost = Σ
    Euclidean distance of each point to its cluster's member mean.

    The fits are independent, so up to ``concurrent_fits`` of them are
    submitted from driver threads at once (Spark schedules the concurrent
    jobs on the same executors), fewer where their vectors would be more than
    ``HELD_ROWS``, the largest models first, as they take longest. Each fit is
    seeded and reads the same layout by id and place, so the curve depends
    neither on the concurrency nor on the cluster. Every k predicts once; with ``facts`` the columns of FACTS_SCHEMA follow.
    """
    vec = for_reuse(assemble(df.select(id_col, *features), features), key=id_col, near=by_place(df, features))
    at_once = max(1, min(concurrent_fits, HELD_ROWS // max(1, vec.count())))  # the count fills the cache

    def one(k: int):
        model, pred = fit_kmeans(vec, features, k, seed=seed, assembled=True)
        pred = pred.select("prediction", *features).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            cost = sum_distance_to_mean(pred, features, "prediction", max_groups=k).first()["cost"]
            row = (int(k), float(cost) if cost is not None else None, "sum_distance")
            return row + fit_facts(model, pred, features, k) if facts else row
        finally:
            pred.unpersist()

    try:
        with ThreadPoolExecutor(max_workers=at_once) as pool:
            found = {row[0]: row for row in pool.map(one, sorted(ks, reverse=True))}
    finally:
        release(vec)
    rows = [found[int(k)] for k in ks]
    return literal_table(df.sparkSession, rows, FACTS_SCHEMA if facts else ELBOW_SCHEMA)


def elbow_lloyd(df: DataFrame, features: Sequence[str], ks: Sequence[int] = DEFAULT_KS,
                tol: float = 2.0, max_iter: int = 50, seed: int = 0, id_col: str = "id") -> DataFrame:
    """Lloyd for every k (advanced together); cost = within-cluster SSE."""
    res = lloyd_sweep(df, features, ks, tol=tol, max_iter=max_iter, seed=seed, id_col=id_col)
    rows = [(int(k), float(sse), "sse") for k, sse, _ in res]
    return literal_table(df.sparkSession, rows, ELBOW_SCHEMA)
