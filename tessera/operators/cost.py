"""Clustering cost: Σ Euclidean distance to the member mean, and within-
cluster SSE, for any labelled DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.distance import euclidean_distance

# Means that take more than this are not broadcast but joined on a salted key.
BROADCAST_BYTES = 64 << 20
LABEL_BYTES = 64  # allowed for a group's label and row overhead
SALTS = 64


def member_means(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Mean of each feature per group, columns ``avg_<f>`` (partial + final agg)."""
    return df.groupBy(label).agg(*[F.avg(f).alias(f"avg_{f}") for f in features])


def sum_distance_to_mean(df: DataFrame, features: Sequence[str], label: str,
                         max_groups: int | None = None) -> DataFrame:
    """One row ``cost`` = Σ over rows of the distance to its group's mean.

    The means table has one row per group, null labels being a group too. It
    is counted first (or bounded by ``max_groups``, k clusters) and broadcast
    when its bytes fit, so the n rows never shuffle. Beyond that the join key
    is salted and the means are repeated for every salt, so that a dominant
    group is spread over SALTS partitions.
    """
    means = member_means(df, features, label).withColumnRenamed(label, "_group")
    groups = means.count() if max_groups is None else max_groups
    if groups * (8 * len(features) + LABEL_BYTES) <= BROADCAST_BYTES:
        joined = df.join(F.broadcast(means), F.col(label).eqNullSafe(F.col("_group")), "left")
    else:
        salted = df.withColumn("_salt", F.pmod(F.hash(*features), F.lit(SALTS)))
        spread = means.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = salted.join(spread, F.col(label).eqNullSafe(F.col("_group")) & (F.col("_salt") == F.col("_part")), "left")
    dist = euclidean_distance([F.col(f) for f in features], [F.col(f"avg_{f}") for f in features])
    return joined.agg(F.sum(dist).alias("cost"))


def cluster_sse(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Per group: n, mean of each feature and SSE = Σ_f var_pop(f)·n.

    One aggregation with map-side partial state (count, mean, M2 per
    feature), so no group is ever materialised and hot groups cost nothing
    extra in the shuffle.
    """
    n = F.count(F.lit(1))
    sse = None
    for f in features:
        term = F.var_pop(f) * n
        sse = term if sse is None else sse + term
    return df.groupBy(label).agg(n.alias("n"), *[F.avg(f).alias(f) for f in features], sse.alias("sse"))


def total_sse(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One row ``sse`` = Σ over groups of the within-group SSE."""
    return cluster_sse(df, features, label).agg(F.sum("sse").alias("sse"))
