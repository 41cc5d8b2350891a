"""Lloyd k-means that skips settled rows.

Every row keeps an upper bound on the distance to its centroid and a lower one
on the distance to all others. When the centroids move, the bounds move by
as much; while the upper bound stays below the lower one, or below half the
way to the nearest other centroid, the row's label cannot have changed and its
k distances are not computed (Hamerly 2010). The state is a written table that
each pass reads and writes anew, so a lost executor repeats part of one pass.

A row is skipped only if its centroid is nearest by a margin far over the
rounding of the bounds, so labels, means and passes are those of
:func:`tessera.operators.lloyd.lloyd`.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import lloyd as L
from tessera.session import Scratch

MARGIN = 1e-9
BLOCK_VALUES = 1 << 20  # distances held at a time

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class BoundedResult(L.LloydResult):
    distances: int = 0   # computed over all passes
    exhaustive: int = 0  # rows x k x passes


def distance_table(at: np.ndarray, cents: np.ndarray) -> np.ndarray:
    out = np.zeros((len(at), len(cents)))
    for j in range(cents.shape[1]):
        away = at[:, j : j + 1] - cents[None, :, j]
        out += away * away
    return np.sqrt(out)


def half_gaps(cents: np.ndarray) -> np.ndarray:
    """Half the way from each centroid to its nearest other one."""
    if len(cents) == 1:
        return np.array([np.inf])
    out = np.empty(len(cents))
    step = max(1, BLOCK_VALUES // len(cents))
    for a in range(0, len(cents), step):
        away = distance_table(cents[a : a + step], cents)
        away[np.arange(len(away)), np.arange(a, a + len(away))] = np.inf
        out[a : a + step] = away.min(axis=1) / 2
    return out


def _advance(state: DataFrame, features: Sequence[str], old: L.Centroids | None, new: L.Centroids, schema: str) -> DataFrame:
    """The state after one assignment to ``new``; without ``old`` every row is
    compared with all centroids."""
    cents = np.asarray(new, dtype=np.float64)
    moved = np.sqrt(((cents - np.asarray(old, dtype=np.float64)) ** 2).sum(axis=1)) if old is not None else None
    gaps, most, dims = half_gaps(cents), len(cents), len(features)
    nearest_rows = L._kernel_functions(BLOCK_VALUES)[1]

    def run(batches):
        for batch in batches:
            at = np.column_stack([batch[f].to_numpy(dtype=np.float64) for f in features])
            whole = ~np.isnan(at).any(axis=1)
            upper, lower = batch["upper"].to_numpy(copy=True), batch["lower"].to_numpy(copy=True)
            label, work = batch["cluster"].fillna(-1).to_numpy(dtype=np.int64, copy=True), np.zeros(len(at), np.int64)
            open_ = whole.copy()
            if moved is not None and whole.any():
                own = np.where(whole, label, 0)
                order = np.argsort(moved)
                away = np.where(own == order[-1], moved[order[-2]] if most > 1 else 0.0, moved[order[-1]])
                upper, lower = upper + moved[own], lower - away
                bar = np.maximum(lower, gaps[own])
                open_ &= ~(upper * (1 + MARGIN) < bar * (1 - MARGIN))
                rows = np.flatnonzero(open_)
                here = at[rows] - cents[own[rows]]
                upper[rows] = np.sqrt((here * here).sum(axis=1))
                work[rows] += 1
                open_[rows] = ~(upper[rows] * (1 + MARGIN) < bar[rows] * (1 - MARGIN))
            rows = np.flatnonzero(open_)
            step = max(1, BLOCK_VALUES // most)
            for k in range(0, len(rows), step):
                some = rows[k : k + step]
                label[some] = nearest_rows(at[some], cents)
                table = distance_table(at[some], cents)
                upper[some] = table[np.arange(len(some)), label[some]]
                table[np.arange(len(some)), label[some]] = np.inf
                lower[some] = table.min(axis=1)
                work[some] += most
            out = {f: at[:, j] for j, f in enumerate(features)}
            yield pd.DataFrame(out | {"cluster": pd.Series(label, dtype="Int32").mask(~whole), "upper": upper, "lower": lower, "work": work})

    assert dims == cents.shape[1]
    return state.mapInPandas(run, schema)


def lloyd_bounded(points: DataFrame, features: Sequence[str], k: int | None = None, init: L.Centroids | None = None,
                  tol: float = 1.5, max_iter: int = 200, seed: int = 0, id_col: str = "id") -> BoundedResult:
    """:func:`tessera.operators.lloyd.lloyd` with bounds: equal labels, means
    and passes, and the number of distances computed."""
    features, scratch = list(features), Scratch(points.sparkSession)
    schema = ", ".join(f"`{f}` double" for f in features) + ", cluster int, upper double, lower double, work long"
    cents = list(init) if init is not None else L.seed_centroids(points, features, k, seed, id_col)
    L._check_size(cents)
    blank = points.select(
        *[F.col(f).cast("double").alias(f) for f in features], F.lit(None).cast("int").alias("cluster"),
        F.lit(0.0).alias("upper"), F.lit(0.0).alias("lower"), F.lit(0).cast("long").alias("work"))
    units, old, history, it, distances, n = L.unit_exponents(blank, features), None, [], 1, 0, 0
    state = blank
    while True:
        state = scratch.write(_advance(state, features, old, cents, schema), f"bounds-{it}")
        rows = L.update_stats(state, features, "cluster", units).collect()
        n, done = state.agg(F.count("cluster"), F.sum("work")).first()
        distances += done or 0
        new, sizes, sse = L._apply_update(cents, rows, features, "cluster")
        shift = sum(L._dist(a, b) for a, b in zip(cents, new))
        history.append((it, shift, sse))
        scratch.drop(f"bounds-{it - 1}")
        if shift < tol or it > max_iter:
            scratch.drop(f"bounds-{it}")
            return BoundedResult(new, cents, sizes, sse, it, history, distances, n * len(cents) * it)
        old, cents = cents, new
        it += 1
