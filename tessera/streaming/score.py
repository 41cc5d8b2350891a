"""Score a stream of located records against fixed centroids."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessera.functions.cyclic import decode_day
from tessera.operators.clean import complete_rows
from tessera.operators.lloyd import Centroids, assign
from tessera.operators.scale import MinMax, scale
from tessera.operators.weekday import attach_weekday


def score_points(stream: DataFrame, mm: MinMax, centroids: Centroids,
                 features=("X_scaled", "Y_scaled", "dow_x", "dow_y")) -> DataFrame:
    """Stream of (id, X, Y, Vkpv) -> (id, X, Y, Day, cluster), using the
    scaling bounds and centroids of a batch fit (stateless: no watermark or
    state store is needed; the 7-row weekday table is a broadcast join)."""
    enc = complete_rows(attach_weekday(stream), ["X", "Y", "dow_x", "dow_y"])
    scaled = scale(enc, mm, ["X", "Y"])
    labelled = assign(scaled, list(features), centroids, "cluster")
    return labelled.select("id", "X", "Y", decode_day("dow_x", "dow_y").alias("Day"), "cluster")
