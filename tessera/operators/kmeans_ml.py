"""k-means through MLlib (k-means|| initialisation, Lloyd passes in MLlib)."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.scale import MinMax

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need numpy and pandas only

def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """Dense vector column of the feature columns (nulls must be cleaned first)."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(df)


def fit_kmeans(df: DataFrame, features: Sequence[str], k: int, seed: int = 1,
               max_iter: int = 20, tol: float = 1e-4, assembled: bool = False) -> tuple[KMeansModel, DataFrame]:
    """Fit k-means; return the model and every input row with ``prediction``.

    Other columns (ids, originals) pass through the assignment. Defaults are
    MLlib's (k-means||, 2 init steps, 20 iterations, tol 1e-4), seed 1.

    The fit sees a projection, which is not marked as cached: MLlib then holds
    the vectors itself for its passes, where it would decode a cached table's
    columns again in each. The solver by rows skips centres by bounds; with
    few features that takes less time than whole distance blocks.
    """
    vec = df if assembled else assemble(df, features)
    km = KMeans(k=k, seed=seed, maxIter=max_iter, tol=tol, featuresCol="features", predictionCol="prediction", solver="row")
    model = km.fit(vec.select("features"))
    return model, model.transform(vec)


def off_nearest(pts: np.ndarray, labels: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Whether each point's labelled centre is farther than its nearest one.

    One matrix product leaves few rows in doubt, which whole differences then
    decide; its margin is far over the rounding of either form."""
    size, most = np.einsum("ij,ij->i", pts, pts), np.einsum("ij,ij->i", centres, centres)
    own = ((pts - centres[labels]) ** 2).sum(axis=1)
    least = (pts @ (-2.0 * centres.T) + most).min(axis=1) + size
    off = np.zeros(len(pts), bool)
    margin = 1e-13 * (size + most.max())
    doubt = np.flatnonzero(own > (least - margin) * (1 + 1e-6) + 1e-12)
    step = max(1, (1 << 18) // len(centres))
    for at in range(0, len(doubt), step):
        rows = doubt[at:at + step]
        d2 = ((pts[rows, None, :] - centres[None]) ** 2).sum(axis=2)
        off[rows] = own[rows] > d2.min(axis=1) * (1 + 1e-6) + 1e-12
    return off


def fit_facts(model: KMeansModel, pred: DataFrame, features: Sequence[str], k: int) -> tuple:
    """(rows, rows with a label, rows whose label is not that of a nearest
    model centre, whether labels stay below k, Σ distance to the member mean
    by literal means) — what any k-means result must satisfy."""
    centres = np.array([np.asarray(c) for c in model.clusterCenters()])
    groups = pred.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"), *[F.avg(f).alias(f) for f in features]).collect()  # k rows
    labelled = [r for r in groups if r.prediction is not None]
    means = {r.prediction: [r[f] for f in features] for r in labelled}
    centroids = np.array([means.get(i, centres[i]) for i in range(len(centres))])
    step, judged = max(1, (1 << 20) // len(centres)), off_nearest

    @F.pandas_udf("off boolean, distance double")
    def judge(batch: pd.DataFrame) -> pd.DataFrame:
        pts, labels = batch.iloc[:, 1:].to_numpy(np.float64), batch.iloc[:, 0].to_numpy()
        parts = [judged(pts[at:at + step], labels[at:at + step], centres) for at in range(0, len(pts), step)]
        off = np.concatenate(parts) if parts else np.zeros(0, bool)
        return pd.DataFrame({"off": off, "distance": np.sqrt(((pts - centroids[labels]) ** 2).sum(axis=1))})

    found = pred.select("prediction", judge(F.struct("prediction", *features)).alias("j")).agg(
        F.count_if("j.off").alias("off"), F.sum("j.distance").alias("cost")).first()
    within = max(means, default=0) < k and len(means) <= k
    return (sum(r.n for r in groups), sum(r.n for r in labelled), found["off"], within, found["cost"])


def member_centroids(pred: DataFrame, mm: MinMax, mapping: dict[str, str],
                     label: str = "prediction") -> DataFrame:
    """Per cluster: size and mean of the assigned members, mapped back to
    original units (``mapping``: scaled column -> output name).

    The mean of the members, not the model's centre, is the reported
    centroid (the two differ when the iteration cap stops MLlib early).
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    for scaled_col, name in mapping.items():
        base = scaled_col[: -len("_scaled")] if scaled_col.endswith("_scaled") else scaled_col
        aggs.append((F.avg(scaled_col) * F.lit(mm.range(base)) + F.lit(mm.lo(base))).alias(name))
    return pred.groupBy(F.col(label).alias("cluster")).agg(*aggs)
