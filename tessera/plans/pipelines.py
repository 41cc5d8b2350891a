"""End-to-end pipelines built from the operators.

Every pipeline starts from a points table ``(id, X, Y, Vkpv)`` (an accident
scan, or the fixture view over ``events``) and returns DataFrames; writing
them out is left to :mod:`tessera.sinks.csv`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tessera.functions.cyclic import decode_day
from tessera.functions.scaling import minmax_unscale
from tessera.operators.clean import complete_rows
from tessera.operators.elbow import DEFAULT_KS, elbow_kmeans, elbow_lloyd
from tessera.operators.kmeans_ml import assemble, fit_facts, fit_kmeans, member_centroids
from tessera.operators.materialize import for_reuse, release
from tessera.operators.lloyd import LloydResult, lloyd
from tessera.operators.scale import MinMax, fit_minmax, scale
from tessera.operators.weekday import attach_weekday
from tessera.sources.local import literal_table

FEATURES_2D = ("X_scaled", "Y_scaled")
FEATURES_4D = ("X_scaled", "Y_scaled", "dow_x_scaled", "dow_y_scaled")
# Lloyd clusters on scaled X/Y and the raw unit-circle weekday point.
FEATURES_LLOYD = ("X_scaled", "Y_scaled", "dow_x", "dow_y")


@dataclass
class Prepared:
    df: DataFrame
    mm: MinMax
    features: tuple[str, ...]


def prepare_2d(points: DataFrame) -> Prepared:
    clean = complete_rows(points.select("id", "X", "Y"), ["X", "Y"])
    mm = fit_minmax(clean, ["X", "Y"])
    return Prepared(scale(clean, mm), mm, FEATURES_2D)


def prepare_4d(points: DataFrame) -> Prepared:
    enc = attach_weekday(points.select("id", "X", "Y", "Vkpv"))
    clean = complete_rows(enc, ["X", "Y", "dow_x", "dow_y"])
    mm = fit_minmax(clean, ["X", "Y", "dow_x", "dow_y"])
    return Prepared(scale(clean, mm), mm, FEATURES_4D)


def prepare_lloyd(points: DataFrame) -> Prepared:
    enc = attach_weekday(points.select("id", "X", "Y", "Vkpv"))
    clean = complete_rows(enc, ["X", "Y", "dow_x", "dow_y"])
    mm = fit_minmax(clean, ["X", "Y"])
    return Prepared(scale(clean, mm, ["X", "Y"]), mm, FEATURES_LLOYD)


def _fit_centroids(p: Prepared, k: int, seed: int, mapping: dict[str, str]) -> DataFrame:
    """Fit on the persisted feature vectors (spread over all cores), reduce to
    ≤ k member-mean rows, release the cache, return the centroids as a small
    literal table."""
    return _fit(p, k, seed, mapping)[0]


def _fit(p: Prepared, k: int, seed: int, mapping: dict[str, str], facts: bool = False):
    vec = for_reuse(assemble(p.df.select("id", *p.features), p.features))
    try:
        model, pred = fit_kmeans(vec, p.features, k, seed=seed, assembled=True)
        cents = member_centroids(pred, p.mm, mapping)
        rows = [tuple(r) for r in cents.collect()]
        found = fit_facts(model, pred.select("prediction", *p.features), p.features, k) if facts else None
    finally:
        release(vec)
    return literal_table(p.df.sparkSession, rows, cents.schema), found


MAPPING_2D = {"X_scaled": "x", "Y_scaled": "y"}
MAPPING_4D = {"X_scaled": "x", "Y_scaled": "y", "dow_x_scaled": "dow_x", "dow_y_scaled": "dow_y"}


def kmeans_checked(points: DataFrame, dims: int, k: int, seed: int = 1) -> tuple[DataFrame, tuple]:
    """The member centroids of a fit and the facts of :func:`fit_facts`."""
    if dims == 2:
        return _fit(prepare_2d(points), k, seed, MAPPING_2D, facts=True)
    return _fit(prepare_4d(points), k, seed, MAPPING_4D, facts=True)


def kmeans_centroids_2d(points: DataFrame, k: int = 300, seed: int = 1) -> DataFrame:
    """MLlib k-means on scaled (X, Y); centroids = member means in metres."""
    return _fit_centroids(prepare_2d(points), k, seed, MAPPING_2D)


def kmeans_centroids_4d(points: DataFrame, k: int = 100, seed: int = 1) -> DataFrame:
    """MLlib k-means on scaled (X, Y, weekday point); adds the decoded weekday."""
    cents = _fit_centroids(prepare_4d(points), k, seed, MAPPING_4D)
    return cents.withColumn("dow", decode_day("dow_x", "dow_y"))


def kmeans_elbow(points: DataFrame, dims: int = 2, ks: Sequence[int] = DEFAULT_KS, seed: int = 1,
                 facts: bool = False) -> DataFrame:
    """dims 2: (X, Y); dims 4 (or 3, the reference's name for it): X, Y and
    the weekday point. Other values are an error, not a silent no-op."""
    if dims not in (2, 3, 4):
        raise ValueError(f"dims must be 2 or 4, got {dims}")
    p = prepare_2d(points) if dims == 2 else prepare_4d(points)
    return elbow_kmeans(p.df, p.features, ks, seed=seed, facts=facts)


@dataclass
class LloydRun:
    prepared: Prepared
    result: LloydResult

    def centroids(self) -> DataFrame:
        """cluster, n, X, Y (metres, each with its own range), Day in (0, 7]."""
        spark = self.prepared.df.sparkSession
        mm = self.prepared.mm
        cents = self.result.frame(spark, self.prepared.features)
        return cents.select(
            "cluster", "n",
            minmax_unscale("X_scaled", mm.lo("X"), mm.hi("X")).alias("X"),
            minmax_unscale("Y_scaled", mm.lo("Y"), mm.hi("Y")).alias("Y"),
            decode_day("dow_x", "dow_y").alias("Day"),
        )

    def labelled_points(self) -> DataFrame:
        """id, Cluster, X, Y (original units), Day — assignment of the last pass."""
        p = self.prepared
        lab = self.result.label(p.df, p.features, "Cluster")
        return lab.select("id", "Cluster", "X", "Y", decode_day("dow_x", "dow_y").alias("Day"))


def lloyd_run(points: DataFrame, k: int = 32, tol: float = 1.5, max_iter: int = 200, seed: int = 0) -> LloydRun:
    p = prepare_lloyd(points)
    return LloydRun(p, lloyd(p.df, p.features, k=k, tol=tol, max_iter=max_iter, seed=seed))


def lloyd_elbow(points: DataFrame, ks: Sequence[int] = DEFAULT_KS, tol: float = 2.0,
                max_iter: int = 50, seed: int = 0) -> DataFrame:
    p = prepare_lloyd(points)
    return elbow_lloyd(p.df, p.features, ks, tol=tol, max_iter=max_iter, seed=seed)

