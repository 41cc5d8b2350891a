"""CSV sinks. Writers run on the executors; only outputs with a proven small
size (≤ k centroid rows, one row per k of an elbow) are gathered into one
file, which gets the very name that was asked for."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite", sep: str = ",") -> None:
    """Every output file gets its own header line, so any subset of the files
    reads back with ``header=true``."""
    df.write.mode(mode).option("header", str(header).lower()).option("sep", sep).csv(path)


def write_csv_file(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> None:
    """``df`` as one plain file ``path``, for small outputs only.

    One task writes it in a staging folder beside the target, and a rename that
    replaces an earlier file commits it. Every attempt has its own staging
    folder and readers see the old file or the new one, so a job may be run
    again at any point. A folder of that name is an error, nothing is deleted.
    """
    spark = df.sparkSession
    fs = spark._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target = fs.Path(path)
    system = target.getFileSystem(conf)
    target = system.makeQualified(target)
    if system.exists(target) and system.getFileStatus(target).isDirectory():
        raise FileExistsError(f"{path} is a folder")
    staging = posixpath.join(target.getParent().toString(), f"_{target.getName()}-{uuid.uuid4().hex[:12]}")
    try:
        write_csv(df.coalesce(1), staging, header, "error", sep)
        parts = [s.getPath() for s in system.listStatus(fs.Path(staging)) if s.getPath().getName().startswith("part-")]
        if len(parts) != 1:
            raise RuntimeError(f"{len(parts)} part files in {staging}")
        rename = getattr(fs, "Options$Rename")
        options = spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        fs.FileContext.getFileContext(target.toUri(), conf).rename(parts[0], target, options)
    finally:
        system.delete(fs.Path(staging), True)


def write_centroids(df: DataFrame, path: str, columns: Sequence[str], order_by: str | None = "cluster") -> None:
    """k rows -> the file ``path`` with header ``columns`` (x,y / x,y,dow / X,Y,Day)."""
    out = df.orderBy(order_by) if order_by else df
    write_csv_file(out.select(*columns), path)


def write_elbow(df: DataFrame, path: str, metric: bool = False) -> None:
    """The file ``path`` with header ``NumOfCluster,Cost``; with ``metric`` a
    third column says whether Cost is a distance sum or an SSE."""
    columns = ["NumOfCluster", "Cost", *(["metric"] if metric else [])]
    write_csv_file(df.select(*columns).orderBy("NumOfCluster"), path)


def write_points(df: DataFrame, path: str, columns: Sequence[str] = ("Cluster", "X", "Y", "Day")) -> None:
    """Labelled points: n rows, written in parallel (never gathered)."""
    write_csv(df.select(*columns), path)


def write_geocoded(df: DataFrame, path: str, one_file: bool = False) -> None:
    """A folder written in parallel; with ``one_file`` (centroids, at most k
    rows) the plain file ``path``."""
    (write_csv_file if one_file else write_csv)(df.select("LONGITUDE", "LATITUDE", "LABEL"), path)
