"""Batch jobs by task number: read the accident file, run the pipeline,
write the result CSVs into ``out_dir`` under the names users of the original
jobs expect (see ``OUTPUT_NAMES``): plain files, but for the labelled points,
which are a folder written in parallel."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.elbow import DEFAULT_KS
from tessera.operators.geocode import geocode
from tessera.plans import pipelines as PL
from tessera.sinks.csv import write_centroids, write_elbow, write_geocoded, write_points
from tessera.sources.delimited import read_accidents, read_coordinates


# Output names per task.
OUTPUT_NAMES = {
    1: ("basic.csv",),
    2: ("task2.csv",),
    4: ("elbow2D.csv", "elbow3D.csv"),
    5: ("task5.csv", "task5_clusteredPoints.csv"),
    6: ("task6.csv",),
}


def accident_points(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """(id, X, Y, Vkpv) from accident files (only 4 of 102 columns are read)."""
    df = read_accidents(spark, path, columns=("Onnett_id", "X", "Y", "Vkpv"), encoding=encoding)
    return df.select(F.col("Onnett_id").cast("bigint").alias("id"), "X", "Y", "Vkpv")


def run_task(spark: SparkSession, task: int, accidents: str, out_dir: str, *,
             ks: Sequence[int] = DEFAULT_KS, seed: int = 0, points: bool = False,
             encoding: str = "UTF-8") -> None:
    pts = accident_points(spark, accidents, encoding)
    if task not in OUTPUT_NAMES:
        raise ValueError(f"unknown task {task}; expected one of {sorted(OUTPUT_NAMES)}")
    out = [os.path.join(out_dir, n) for n in OUTPUT_NAMES[task]]
    if task == 1:
        write_centroids(PL.kmeans_centroids_2d(pts, k=300), out[0], ["x", "y"])
    elif task == 2:
        write_centroids(PL.kmeans_centroids_4d(pts, k=100), out[0], ["x", "y", "dow"])
    elif task == 4:
        write_elbow(PL.kmeans_elbow(pts, dims=2, ks=ks), out[0])
        write_elbow(PL.kmeans_elbow(pts, dims=4, ks=ks), out[1])
    elif task == 5:
        run = PL.lloyd_run(pts, k=32, tol=1.5, max_iter=200, seed=seed)
        write_centroids(run.centroids(), out[0], ["X", "Y", "Day"])
        if points:
            write_points(run.labelled_points(), out[1])
    else:
        write_elbow(PL.lloyd_elbow(pts, ks=ks, tol=2.0, max_iter=50, seed=seed), out[0])


def geocode_file(spark: SparkSession, in_path: str, out_path: str, one_file: bool = False) -> None:
    """``x,y[,label]`` grid coordinates -> ``LONGITUDE,LATITUDE,LABEL``, as a
    folder or, for the few rows of a centroid file, as one plain file."""
    write_geocoded(geocode(read_coordinates(spark, in_path)), out_path, one_file)
