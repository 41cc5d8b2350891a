"""Saved pipelines, plain result files, seeds in one pass."""

import os

import pytest

from tessera.operators import bottom_k as B
from tessera.operators.kmeans_pipeline import differing_labels, fit_pipeline, learned_range, load_pipeline, save_pipeline, score
from tessera.operators.lloyd import sample_seeds, seed_order
from tessera.plans.jobs import geocode_file, run_task
from tessera.sinks.csv import write_csv, write_csv_file
from tessera.sources import fixtures as FX
from tests.conftest import SF_SMALL


def points(spark, n=3000):
    return spark.range(n).selectExpr("id", "id * 7919 % 1009 + 0.5D AS a", "IF(id % 50 = 0, NULL, IF(id % 50 = 1, double('nan'), id * 31 % 97 + 0.0D)) AS b")


def test_reloaded_model_gives_the_fits_labels(spark, tmp_path):
    df, path = points(spark), str(tmp_path / "model")
    fitted = fit_pipeline(df, ["a", "b"], k=7)
    save_pipeline(fitted, path)
    save_pipeline(fitted, path)  # an earlier model is replaced
    loaded = load_pipeline(path)
    assert tuple(differing_labels(score(fitted, df), score(loaded, df)).first()) == (2880, 2880, 0)
    assert score(loaded, df).columns == ["id", "a", "b", "prediction"]
    again = fit_pipeline(df.repartition(3), ["a", "b"], k=7)
    assert differing_labels(score(again, df), score(loaded, df)).first().n_differing == 0
    assert learned_range(loaded).bounds == {"a": (0.5, 1008.5), "b": (0.0, 96.0)}
    assert score(loaded, df.limit(0)).count() == 0


def test_one_plain_file_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "new" / "out.csv")
    for n in (40, 3, 0):
        write_csv_file(spark.range(n).orderBy("id"), path)
        assert os.path.isfile(path)
        with open(path) as f:
            assert f.read().split() == ["id", *map(str, range(n))]
        assert spark.read.option("header", "true").csv(path).count() == n
    assert [f for f in os.listdir(tmp_path / "new") if not f.startswith(".")] == ["out.csv"]


def test_failed_attempt_leaves_the_old_file(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    write_csv_file(spark.range(5), path)
    with pytest.raises(Exception, match="no such"):
        write_csv_file(spark.range(9).selectExpr("CAST(raise_error('no such') AS INT) AS id"), path)
    assert spark.read.option("header", "true").csv(path).count() == 5
    assert [f for f in os.listdir(tmp_path) if not f.startswith(".")] == ["out.csv"]
    folder = str(tmp_path / "folder")
    write_csv(spark.range(5), folder)
    with pytest.raises(FileExistsError):
        write_csv_file(spark.range(5), folder)
    assert spark.read.option("header", "true").csv(folder).count() == 5


def test_tasks_leave_plain_files(spark, tmp_path):
    accidents, out = str(tmp_path / "accidents"), str(tmp_path / "results")
    write_csv(FX.accident_table(spark, SF_SMALL), accidents, sep=";")
    for _ in range(2):
        run_task(spark, 5, accidents, out)
    run_task(spark, 6, accidents, out, ks=[2, 12])
    assert sorted(f for f in os.listdir(out) if not f.startswith(".")) == ["task5.csv", "task6.csv"]
    assert all(os.path.isfile(os.path.join(out, f)) for f in os.listdir(out))
    with open(os.path.join(out, "task5.csv")) as f:
        assert f.readline() == "X,Y,Day\n" and len(f.readlines()) == 32
    source = tmp_path / "c.csv"
    source.write_text("x,y,label\n385000,6672000,Helsinki\n")
    geocode_file(spark, str(source), os.path.join(out, "places.csv"), one_file=True)
    with open(os.path.join(out, "places.csv")) as f:
        assert f.readline() == "LONGITUDE,LATITUDE,LABEL\n" and f.readline().endswith(",Helsinki\n")


@pytest.mark.parametrize("k", [1, 32, 302, 5000])
def test_bottom_k_equals_a_full_sort(spark, k, monkeypatch):
    monkeypatch.setattr(B, "SLACK", 100)  # tasks select again and again
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        df = spark.range(0, 4000, 1, 5).selectExpr("id", "CAST(id AS DOUBLE) AS a")
        rows = df.select(seed_order("id", 3).alias("_h"), "id", "a")
        want = [tuple(r) for r in rows.orderBy("_h", "id").limit(k).collect()]
        assert [tuple(r) for r in B.bottom_k(rows, ["_h", "id"], k).collect()] == want
        seeds = sample_seeds(df, ["a"], k, seed=3).orderBy("idx").collect()
        assert [r.id for r in seeds] == [w[1] for w in want] and [r.idx for r in seeds] == list(range(len(want)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_bottom_k_of_few_rows_and_none(spark):
    rows = spark.range(6).selectExpr("id")
    assert [r.id for r in B.bottom_k(rows, ["id"], 9).collect()] == list(range(6))
    assert B.bottom_k(rows.limit(0), ["id"], 9).count() == 0


def test_labels_off_the_nearest_centre_are_found():
    import numpy as np
    from tessera.operators.kmeans_ml import off_nearest

    rng = np.random.default_rng(3)
    for base in (0.0, 1e7):
        pts, centres = base + rng.random((5000, 4)), base + rng.random((37, 4))
        d2 = ((pts[:, None, :] - centres[None]) ** 2).sum(axis=2)
        labels = d2.argmin(axis=1)
        assert not off_nearest(pts, labels, centres).any()
        labels[::7] = (labels[::7] + 1) % 37
        assert off_nearest(pts, labels, centres).tolist() == [k % 7 == 0 for k in range(5000)]


def test_few_fits_hold_many_rows(spark, monkeypatch):
    """Fits at a time follow the rows that they hold."""
    from tessera.operators import elbow

    seen, real = [], elbow.ThreadPoolExecutor
    monkeypatch.setattr(elbow, "ThreadPoolExecutor", lambda max_workers: seen.append(max_workers) or real(max_workers))
    monkeypatch.setattr(elbow, "HELD_ROWS", 100)
    rows = spark.createDataFrame([(k, float(k % 7), float(k % 5)) for k in range(50)], "id long, a double, b double")
    assert elbow.elbow_kmeans(rows, ["a", "b"], ks=(2, 3)).count() == 2 and seen == [2]


def test_elbow_fits_meet_neighbours_together(spark, monkeypatch):
    """Rows of one region follow each other, none is lost, and the largest
    models go first; the curve is in the order that was asked for."""
    from tessera.operators import elbow

    rows = [(k, float(k * 7919 % 1009), float(k * 104729 % 997) - 1e3) for k in range(4000)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    seen, plain = [], elbow.fit_kmeans

    def kept(vec, features, k, **more):
        seen.append((k, vec.rdd.mapPartitions(lambda part: [[(r.id, r.a, r.b) for r in part]]).collect()))
        return plain(vec, features, k, **more)

    monkeypatch.setattr(elbow, "fit_kmeans", kept)
    got = elbow.elbow_kmeans(df, ["a", "b"], ks=(3, 2, 5), concurrent_fits=1).collect()
    assert [r.NumOfCluster for r in got] == [3, 2, 5] and [k for k, _ in seen] == [5, 3, 2]
    parts = seen[0][1]
    assert all(p == parts for _, p in seen) and sorted(r for p in parts for r in p) == rows
    way = lambda p: sum(abs(x[1] - y[1]) + abs(x[2] - y[2]) for x, y in zip(p, p[1:]))
    for p in parts:
        assert way(p) < 0.75 * way(sorted(p))


def test_elbow_of_constant_features(spark):
    from tessera.operators.elbow import elbow_kmeans

    rows = spark.createDataFrame([(k, 3.0, float(k % 4)) for k in range(40)], "id long, a double, b double")
    got = elbow_kmeans(rows, ["a", "b"], ks=(2, 4), facts=True).collect()
    assert [(r.n_rows, r.n_assigned, r.n_off_nearest, r.within_k) for r in got] == [(40, 40, 0, True)] * 2
