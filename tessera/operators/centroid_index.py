"""Nearest centroids among any number of them.

Up to ``CENTROID_VALUE_LIMIT`` values the centroids travel in the plan. Beyond
it they are a written table with an index of two levels: some sqrt(k) of them
are pivots, every centroid belongs to the cell of its nearest pivot, and a
cell is cut into leaves of about ``LEAF`` centroids. Only the pivots and two
radii a cell are on the driver.

A point first meets a leaf of its own cell, which gives a centroid at some
distance u. Any nearer one lies in a cell that two lower bounds leave open:
the distance to the cell's pivot less the cell's radius, and the distance to
the plane halfway between the two pivots. The point meets the leaves of the
open cells, and the nearest of all, of equals the lowest index, is the answer;
so labels are those of the exhaustive search.

Points and leaves meet as one sorted stream: both are dealt by leaf, a leaf's
centroids come before its points, and a task holds one leaf at a time. A leaf
that many points meet is dealt to as many parts as its points need.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.distance import squared_distance
from tessera.operators import lloyd as L
from tessera.operators.materialize import for_reuse, release
from tessera.operators.numbering import numbered
from tessera.session import Scratch

LEAF = 4096
MOST_PIVOTS = 65_536
POINTS_A_PART = 200_000  # points that one task compares with a leaf
SMALL_LEAVES = 1_000_000  # rows of a (leaf, parts) table that may be broadcast
BLOCK_VALUES = 1 << 22  # distances to pivots held at a time
SLACK = 1e-9  # relative margin of the bounds, far over their rounding

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need numpy only


@dataclass
class CentroidIndex:
    features: tuple[str, ...]
    table: DataFrame          # (leaf, idx, features), written
    pivots: np.ndarray
    radius: np.ndarray        # of each cell; -inf if it is empty
    first_leaf: np.ndarray    # per cell, and the number of leaves at the end
    scratch: Scratch = field(repr=False)

    def drop(self) -> None:
        self.scratch.drop("leaves")


def centroid_table(spark: SparkSession, centroids: L.Centroids, features: Sequence[str]) -> DataFrame:
    """(idx, features) of centroids that the driver has."""
    frame = pd.DataFrame(np.asarray(centroids, dtype=np.float64), columns=list(features))
    frame.insert(0, "idx", np.arange(len(frame), dtype=np.int64))
    return spark.createDataFrame(frame)


def _matrix(batch: pd.DataFrame, names: Sequence[str]) -> np.ndarray:
    return np.column_stack([batch[n].to_numpy(dtype=np.float64) for n in names])


def _square_of(away: np.ndarray) -> np.ndarray:
    """Σ of squares, left to right as the column expression adds them."""
    out = away[:, 0] * away[:, 0]
    for j in range(1, away.shape[1]):
        out = out + away[:, j] * away[:, j]
    return out


def build(centroids: DataFrame, features: Sequence[str], scratch: Scratch | None = None) -> CentroidIndex:
    """The index of ``centroids`` (idx, features); idx is any unique integer."""
    scratch = scratch or Scratch(centroids.sparkSession)
    features = tuple(features)
    size = centroids.count()
    if not size:
        raise ValueError("no centroids (empty input?)")
    most = max(1, min(MOST_PIVOTS, L.CENTROID_VALUE_LIMIT // len(features)))
    seeds = L.seed_centroids(centroids, features, min(most, math.isqrt(size - 1) + 1), 0, "idx")
    pivots = np.asarray(seeds, dtype=np.float64)
    nearest_rows, square_of, matrix = L._kernel_functions(BLOCK_VALUES)[1], _square_of, _matrix

    def place(batches):
        for batch in batches:
            at = matrix(batch, features)
            cell = nearest_rows(at, pivots)
            yield batch.assign(cell=cell, _r=np.sqrt(square_of(at - pivots[cell])))

    fields = "idx long, " + ", ".join(f"`{f}` double" for f in features)
    plain = centroids.select(F.col("idx").cast("long"), *[F.col(f).cast("double") for f in features])
    cells = scratch.write(plain.mapInPandas(place, fields + ", cell int, _r double"), "cells")
    stats = cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("_r").alias("r")).collect()  # one row a pivot at most
    radius, leaves = np.full(len(pivots), -np.inf), np.zeros(len(pivots), np.int64)
    for r in stats:
        radius[r.cell], leaves[r.cell] = r.r, -(-r.n // LEAF)
    first = np.concatenate([[0], np.cumsum(leaves)])
    spread = F.pmod(F.xxhash64("idx"), F.element_at(F.lit(leaves.tolist()), F.col("cell") + 1))
    leaf = (F.element_at(F.lit(first.tolist()), F.col("cell") + 1) + spread).cast("int")
    table = cells.select(leaf.alias("leaf"), "idx", *features).repartition("leaf").sortWithinPartitions("leaf", "idx")
    index = CentroidIndex(features, scratch.write(table, "leaves"), pivots, radius, first, scratch)
    scratch.drop("cells")
    return index


def _meet(points: DataFrame, index: CentroidIndex) -> DataFrame:
    """``points`` (_row, leaf, features) with d2 and idx of the nearest centroid
    of their leaf (infinity and null in an empty one)."""
    features = index.features
    parts = points.groupBy("leaf").agg(F.ceil(F.count("*") / POINTS_A_PART).cast("int").alias("parts"))
    parts = index.scratch.write(parts, "parts")
    parts = F.broadcast(parts) if parts.count() <= SMALL_LEAVES else parts
    dealt = points.join(parts, "leaf").withColumn("part", F.expr("CAST(pmod(xxhash64(_row), parts) AS INT)"))
    held = index.table.join(parts, "leaf").withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
    columns = ["leaf", "part", "kind", "num", *features]
    both = held.select("leaf", "part", F.lit(0).alias("kind"), F.col("idx").alias("num"), *features).unionByName(
        dealt.select("leaf", "part", F.lit(1).alias("kind"), F.col("_row").alias("num"), *features))
    stream = both.select(*columns).repartition("leaf", "part").sortWithinPartitions("leaf", "part", "kind", "num")
    nearest_rows, square_of, matrix = L._kernel_functions(BLOCK_VALUES)[1], _square_of, _matrix

    def compare(batches):
        current, names, at = None, [], []
        for batch in batches:
            key = batch[["leaf", "part", "kind"]].to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)])).tolist() + [len(key)]
            values, numbers = matrix(batch, features), batch["num"].to_numpy()
            for a, b in zip(edges[:-1], edges[1:]):
                leaf = tuple(key[a, :2])
                if leaf != current:
                    current, names, at = leaf, [], []
                if key[a, 2] == 0:
                    names.append(numbers[a:b])
                    at.append(values[a:b])
                    continue
                out = {"_row": numbers[a:b], "leaf": key[a:b, 0]} | {f: values[a:b, j] for j, f in enumerate(features)}
                if not at:
                    yield pd.DataFrame(out | {"d2": np.inf, "idx": pd.array([None] * (b - a), dtype="Int64")})
                    continue
                if len(at) > 1:
                    names, at = [np.concatenate(names)], [np.concatenate(at)]
                best = nearest_rows(values[a:b], at[0])
                yield pd.DataFrame(out | {"d2": square_of(values[a:b] - at[0][best]), "idx": names[0][best]})

    fields = "_row long, leaf int, " + ", ".join(f"`{f}` double" for f in features)
    return stream.mapInPandas(compare, fields + ", d2 double, idx long")


def labels(rows: DataFrame, index: CentroidIndex, keep: bool = False) -> DataFrame:
    """(_row, idx) of the nearest centroid of every row of ``rows`` (_row,
    features) without a missing feature; with ``keep`` also the features."""
    features, scratch = index.features, index.scratch
    pivots, radius, first = index.pivots, index.radius, index.first_leaf
    nearest_rows, matrix = L._kernel_functions(BLOCK_VALUES)[1], _matrix

    @F.pandas_udf("int")
    def own_leaf(number: pd.Series, values: pd.DataFrame) -> pd.Series:
        cell = nearest_rows(matrix(values, values.columns), pivots)
        return pd.Series((first[cell] + number.to_numpy() % (first[cell + 1] - first[cell])).astype(np.int32))

    @F.pandas_udf("array<int>")
    def open_leaves(leaf: pd.Series, d2: pd.Series, values: pd.DataFrame) -> pd.Series:
        out, at, step = [], matrix(values, values.columns), max(1, BLOCK_VALUES // len(pivots))
        own, reach = leaf.to_numpy(), np.sqrt(d2.to_numpy())
        for k in range(0, len(at), step):
            some, mine, u = at[k : k + step], own[k : k + step], reach[k : k + step, None]
            away = np.sqrt(np.maximum(0.0, sum((some[:, j, None] - pivots[None, :, j]) ** 2 for j in range(some.shape[1]))))
            cell = np.searchsorted(first, mine, "right") - 1
            near = away[np.arange(len(some)), cell][:, None]
            between = np.sqrt(sum((pivots[cell, j, None] - pivots[None, :, j]) ** 2 for j in range(some.shape[1])))
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = np.where(between > 0, (away * away - near * near) / (2 * between), 0.0)
            least = np.maximum(away - radius, plane)
            slack = SLACK * (away + near + u)
            # the plane's rounding grows where pivots are close to each other
            slack = np.where(between > 0, slack * np.maximum(1.0, (away + near) / np.maximum(between, 1e-300)), slack)
            for row, cells in enumerate((least <= u + slack) & (radius > -np.inf)):
                found = [np.arange(first[c], first[c + 1]) for c in np.flatnonzero(cells)]
                found = np.concatenate(found) if found else np.zeros(0, np.int64)
                out.append(found[found != mine[row]].astype(np.int32))
        return pd.Series(out)

    coordinates = F.struct(*[F.col(f) for f in features])
    begun = scratch.write(_meet(rows.withColumn("leaf", own_leaf("_row", coordinates)), index), "met")
    spread = scratch.write(begun.withColumn("more", open_leaves("leaf", "d2", coordinates)), "open")
    probes = spread.where("size(more) > 0").select("_row", F.explode("more").alias("leaf"), *features)
    kept = ["idx", *features] if keep else ["idx"]
    wider = _meet(probes, index).select("_row", "d2", *kept)
    best = F.min(F.struct("d2", *kept)).alias("b")
    again = spread.where("size(more) > 0").select("_row", "d2", *kept).unionByName(wider).where("idx IS NOT NULL").groupBy("_row").agg(best)
    found = spread.where("size(more) = 0").select("_row", *kept).unionByName(again.select("_row", *[F.col("b")[c].alias(c) for c in kept]))
    out = scratch.write(found, "labels")
    scratch.drop("met", "open", "parts")
    return out


def whole_rows(numbered_: DataFrame, features: Sequence[str]) -> DataFrame:
    """(_row, features) of the rows without a missing feature."""
    whole = [F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double")) for f in features]
    rows = numbered_.select("_row", *[F.col(f).cast("double").alias(f) for f in features], *[w.alias(f"_w{j}") for j, w in enumerate(whole)])
    return rows.where(" AND ".join(f"_w{j}" for j in range(len(whole)))).select("_row", *features)


def assign_indexed(df: DataFrame, features: Sequence[str], index: CentroidIndex, out: str = "cluster") -> DataFrame:
    """``df`` with the index of its nearest centroid; null where a feature is
    null or NaN."""
    numbered_ = index.scratch.write(df.withColumn("_row", F.monotonically_increasing_id()), "points")
    found = labels(whole_rows(numbered_, features), index).select("_row", F.col("idx").cast("int").alias(out))
    return numbered_.drop(out).join(found, "_row", "left").drop("_row")


@dataclass
class LloydTables:
    """A run whose centroids are written tables."""

    features: tuple[str, ...]
    centroids: DataFrame      # (idx, features) after the last pass
    assigned_with: DataFrame  # those of the last assignment
    counts: DataFrame         # (idx, n)
    sse: float
    passes: int
    history: list[tuple[int, float, float]]

    def frame(self, spark: SparkSession, features: Sequence[str]) -> DataFrame:
        rows = self.centroids.join(self.counts, "idx", "left")
        return rows.select(F.col("idx").cast("int").alias("cluster"), F.coalesce("n", F.lit(0)).alias("n"), *features)

    def label(self, df: DataFrame, features: Sequence[str], out: str = "cluster") -> DataFrame:
        return assign_indexed(df, features, build(self.assigned_with, features), out)


def seed_table(df: DataFrame, features: Sequence[str], k: int, seed: int, id_col: str, scratch: Scratch) -> DataFrame:
    """(idx, features) of the first k rows in md5 order, for any k."""
    rows = df.select(L.seed_order(id_col, seed).alias("_h"), F.col(id_col).alias("_id"), *features)
    return numbered(rows, ["_h", "_id"], "idx", scratch, "seeds").where(F.col("idx") < k).select("idx", *features)


def lloyd_indexed(points: DataFrame, features: Sequence[str], k: int | None = None, init: L.Centroids | None = None,
                  tol: float = 1.5, max_iter: int = 200, seed: int = 0, id_col: str = "id", reuse: str = "cache") -> LloydTables:
    """:func:`tessera.operators.lloyd.lloyd` for any number of centroids: they
    stay in written tables, and no list of them reaches the driver."""
    spark, features = points.sparkSession, tuple(features)
    scratch = Scratch(spark)
    pts = for_reuse(points.select(id_col, *features), reuse, laid_out=False)
    try:
        cents = centroid_table(spark, init, features) if init is not None else seed_table(pts, features, k, seed, id_col, scratch)
        cents = scratch.write(cents, "centroids-0")
        units, history, it = L.unit_exponents(pts, features), [], 1
        # numbered and written once; the labels bring the features, so that no pass joins its points
        rows = scratch.write(whole_rows(pts.withColumn("_row", F.monotonically_increasing_id()), features), "points")
        while True:
            index = build(cents, features, Scratch(spark))
            found = labels(rows, index, keep=True).withColumnRenamed("idx", "cluster")
            stats = L.update_stats(found, features, "cluster", units)
            new = {f: f"_new_{f}" for f in features}
            stats = scratch.write(stats.select(F.col("cluster").cast("long").alias("idx"), "n", "sse", *[F.col(f).alias(n) for f, n in new.items()]), f"stats-{it}")
            moved = cents.join(stats, "idx", "left").withColumns({n: F.coalesce(n, f) for f, n in new.items()})
            dist = F.sqrt(squared_distance([F.col(f) for f in features], [F.col(n) for n in new.values()]))
            shift, sse = moved.agg(F.sum(dist), F.sum("sse")).first()
            history.append((it, shift, sse or 0.0))
            after = scratch.write(moved.select("idx", *[F.col(n).alias(f) for f, n in new.items()]), f"centroids-{it}")
            index.scratch.drop(*list(index.scratch.paths))
            if shift < tol or it > max_iter:
                return LloydTables(features, after, cents, stats.select("idx", "n"), sse or 0.0, it, history)
            scratch.drop(f"centroids-{it - 1}", f"stats-{it}", "seeds")
            cents = after
            it += 1
    finally:
        release(pts)
