"""k-means as one fitted pipeline that outlives its session.

Assembling, min-max scaling and clustering are stages of one ``PipelineModel``:
what the fit learned (extremes, centres) is saved with it, and a later session
scores raw features without a fit and without the extremes being passed along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.materialize import for_reuse, release
from tessera.operators.scale import MinMax


def fit_pipeline(df: DataFrame, features: Sequence[str], k: int, seed: int = 1, max_iter: int = 20,
                 tol: float = 1e-4, id_col: str = "id") -> PipelineModel:
    """Fit on the rows laid out by ``id_col``, so that equal tables give equal
    models on any cluster. Rows with a null or NaN feature are skipped, in the
    fit as in scoring."""
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="raw_features", handleInvalid="skip"),
        MinMaxScaler(inputCol="raw_features", outputCol="features"),
        KMeans(k=k, seed=seed, maxIter=max_iter, tol=tol, featuresCol="features", predictionCol="prediction"),
    ]
    rows = for_reuse(df.select(id_col, *features), key=id_col)
    try:
        return Pipeline(stages=stages).fit(rows)
    finally:
        release(rows)


def save_pipeline(model: PipelineModel, path: str) -> None:
    """Into a folder of any file system that Spark writes; an earlier model
    there is replaced."""
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with ``prediction``, without the rows that miss a feature."""
    return model.transform(df).drop("raw_features", "features")


def scaled_features(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``prediction`` and the scaled features, one column ``<feature>_scaled`` each."""
    names = model.stages[0].getInputCols()
    array = vector_to_array("features")
    return model.transform(df).select("prediction", *[array[i].alias(f"{n}_scaled") for i, n in enumerate(names)])


def learned_range(model: PipelineModel) -> MinMax:
    """The extremes that the scaling stage learned."""
    scaler = model.stages[1]
    low, high = scaler.originalMin.toArray(), scaler.originalMax.toArray()
    return MinMax({n: (float(a), float(b)) for n, a, b in zip(model.stages[0].getInputCols(), low, high)})


def differing_labels(one: DataFrame, two: DataFrame, id_col: str = "id") -> DataFrame:
    """n rows, n labelled in ``two``, n whose label is not the same in both."""
    both = one.select(id_col, F.col("prediction").alias("a")).join(two.select(id_col, F.col("prediction").alias("b")), id_col, "full")
    return both.agg(F.count("*").alias("n_rows"), F.count("b").alias("n_assigned"), F.count_if(F.expr("NOT (a <=> b)")).alias("n_differing"))
