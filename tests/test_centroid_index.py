"""Centroids beyond the plan, numbering, bounds and exact sums."""

import math
import random

import pytest

from tessera.operators import centroid_index as CI
from tessera.operators import lloyd as L
from tessera.operators import lloyd_bounded as LB
from tessera.operators.numbering import numbered
from tessera.session import Scratch


def _points(spark, n=1500, seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(n)] + [(n, None, 1.0), (n + 1, float("nan"), 1.0), (n + 2, 0.5, 0.5), (n + 2, 0.5, 0.5)]
    return spark.createDataFrame(rows, "id long, a double, b double").repartition(5)


def _centroids(n, seed=2):
    rng = random.Random(seed)
    out = [(rng.gauss(0, 1), rng.gauss(0, 1)) for _ in range(n)]
    return out + out[:7] + [(0.5, 0.5)] * 5 + [(9.0, 9.0), (0.5, 0.5 + 1e-12)]


def _labels(df):
    return sorted(((r.id, r.cluster) for r in df.collect()), key=repr)


@pytest.mark.parametrize("k,leaf,part", [(1, 10, 10), (90, 8, 50), (400, 4096, 200_000), (400, 5, 30)])
def test_index_gives_the_kernels_labels(spark, monkeypatch, k, leaf, part):
    monkeypatch.setattr(CI, "LEAF", leaf)
    monkeypatch.setattr(CI, "POINTS_A_PART", part)
    cents = _centroids(k) if k > 1 else [(0.1, 0.2)]
    df = _points(spark)
    assert _labels(L.assign(df, ["a", "b"], cents, method="index")) == _labels(L.assign(df, ["a", "b"], cents, method="arrow"))


def test_far_and_scaled_points(spark):
    rng = random.Random(3)
    rows = [(i, rng.uniform(-1, 1) * 10.0 ** rng.randrange(-9, 9), rng.uniform(0, 1)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    cents = [(a, b) for _, a, b in rows[:60]]
    assert _labels(L.assign(df, ["a", "b"], cents, method="index")) == _labels(L.assign(df, ["a", "b"], cents, method="arrow"))


def test_no_limit_raises_any_more(spark, monkeypatch):
    df, cents = _points(spark, 300), _centroids(40)
    plain = L.lloyd(df, ["a", "b"], k=12, tol=0.0, max_iter=3)
    labels = _labels(plain.label(df, ["a", "b"]))
    want = _labels(L.assign(df, ["a", "b"], cents))
    sweep = L.lloyd_sweep(df, ["a", "b"], [2, 12], tol=0.0, max_iter=2)
    monkeypatch.setattr(L, "CENTROID_VALUE_LIMIT", 10)
    assert _labels(L.assign(df, ["a", "b"], cents)) == want
    table = L.lloyd(df, ["a", "b"], k=12, tol=0.0, max_iter=3)
    assert isinstance(table, CI.LloydTables) and table.passes == plain.passes
    got = sorted((r.cluster, r.n, r.a, r.b) for r in table.frame(spark, ["a", "b"]).collect())
    assert got == [(i, plain.sizes[i], *c) for i, c in enumerate(plain.centroids)]
    assert _labels(table.label(df, ["a", "b"])) == labels
    for (k, sse, it), (k2, sse2, it2) in zip(sweep, L.lloyd_sweep(df, ["a", "b"], [2, 12], tol=0.0, max_iter=2)):
        assert (k, it) == (k2, it2) and math.isclose(sse, sse2, rel_tol=1e-9)


def test_emptied_clusters_stay_in_the_tables(spark):
    df = spark.createDataFrame([(i, float(i % 3), 0.0) for i in range(30)], "id long, a double, b double")
    res = L.lloyd(df, ["a", "b"], init=[(0.0, 0.0), (1.0, 0.0), (50.0, 50.0)], tol=0.5, max_iter=5, method="index")
    rows = {r.cluster: (r.n, r.a, r.b) for r in res.frame(spark, ["a", "b"]).collect()}
    assert rows[2] == (0, 50.0, 50.0) and rows[0][0] + rows[1][0] == 30


def test_no_centroids(spark):
    with pytest.raises(ValueError):
        CI.build(spark.createDataFrame([], "idx long, a double"), ["a"])


def test_numbers_are_dense_and_in_order(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(500), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "v int, i int").repartition(7)
    got = numbered(df, ["v", "i"], "n", Scratch(spark))
    assert [(r.v, r.i) for r in got.orderBy("n").collect()] == sorted(rows)
    assert sorted(r.n for r in got.collect()) == list(range(2000))
    assert "SinglePartition" not in got._jdf.queryExecution().toString()
    assert numbered(df.limit(0), ["v"], "n", Scratch(spark)).count() == 0


@pytest.mark.parametrize("k", [1, 2, 6])
def test_bounds_change_nothing(spark, k):
    rng = random.Random(5)
    rows = [(i, rng.gauss(3 * (i % 6), 0.3), rng.gauss(0, 0.3)) for i in range(600)] + [(600, None, 0.0), (601, float("nan"), 0.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double").repartition(3)
    plain = L.lloyd(df, ["a", "b"], k=k, tol=0.0, max_iter=14)
    fast = LB.lloyd_bounded(df, ["a", "b"], k=k, tol=0.0, max_iter=14)
    assert (fast.centroids, fast.assigned_with, fast.sizes, fast.passes) == (plain.centroids, plain.assigned_with, plain.sizes, plain.passes)
    assert fast.exhaustive == 600 * k * fast.passes
    if k == 6:
        assert 3 * fast.distances < fast.exhaustive


@pytest.mark.parametrize("scale", [1e-9, 1.0, 1e7, 1e12, 1e300])
def test_means_are_exact_at_any_size(spark, scale):
    rng = random.Random(6)
    values = [(rng.uniform(1.5, 2.5) if i % 2 else -rng.uniform(1.5, 2.5)) * scale for i in range(501)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, x double").repartition(4)
    mean = math.fsum(values) / len(values)
    one = L.update_stats(L.assign(df, ["x"], [(0.0,)]), ["x"]).first()
    two = L.sweep_stats(df, ["x"], {1: [(0.0,)]}).first()
    for got in (one, two):
        assert got.n == 501 and math.isclose(got.x, mean, rel_tol=1e-15, abs_tol=1e-17 * scale)
    if scale < 1e100:
        sse = math.fsum((v - mean) ** 2 for v in values)
        assert math.isclose(one.sse, sse, rel_tol=1e-9) and math.isclose(two.sse, sse, rel_tol=1e-9)


def test_the_largest_values_near_the_old_limit(spark):
    values = [2.0e7 + i for i in range(6)]
    df = spark.createDataFrame(list(enumerate(values)), "id long, a double")
    for got in (L.update_stats(L.assign(df, ["a"], [(0.0,)]), ["a"]).first(), L.sweep_stats(df, ["a"], {1: [(0.0,)]}).first()):
        assert got.a == 2.0e7 + 2.5 and math.isclose(got.sse, 17.5, rel_tol=1e-6)


def test_infinite_values_raise(spark):
    df = spark.createDataFrame([(1, float("inf"))], "id long, a double")
    with pytest.raises(ValueError):
        L.lloyd(df, ["a"], init=[(0.0,)])


def test_points_are_numbered_once_a_run(spark, monkeypatch):
    names, write = [], Scratch.write
    monkeypatch.setattr(Scratch, "write", lambda self, df, name, **options: names.append((name, df.columns)) or write(self, df, name, **options))
    df = _points(spark, 200)
    res = L.lloyd(df, ["a", "b"], k=5, tol=0.0, max_iter=1, method="index")
    assert res.passes == 2 and [n for n, _ in names].count("points") == 1
    assert all(columns == ["_row", "idx", "a", "b"] for n, columns in names if n == "labels")
    plain = L.lloyd(df, ["a", "b"], k=5, tol=0.0, max_iter=1)
    assert [tuple(r) for r in res.frame(spark, ["a", "b"]).orderBy("cluster").collect()] == [(i, n, *c) for i, (n, c) in enumerate(zip(plain.sizes, plain.centroids))]
