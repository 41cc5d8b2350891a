import os

from tessera.operators.lloyd import assign
from tessera.plans import pipelines as PL
from tessera.plans.jobs import geocode_file, run_task
from tessera.sinks.csv import write_csv
from tessera.sources import fixtures as FX
from tessera.streaming.score import score_points
from tests.conftest import SF_SMALL


def test_stream_scoring_equals_batch(spark, tmp_path):
    pts = FX.accident_points(spark, SF_SMALL)
    run = PL.lloyd_run(pts, k=8, tol=1.5, max_iter=20)
    src = str(tmp_path / "in")
    pts.write.parquet(src)
    stream = spark.readStream.schema(pts.schema).parquet(src)
    q = (score_points(stream, run.prepared.mm, run.result.centroids)
         .writeStream.format("memory").queryName("scored").outputMode("append").start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r.id: r.cluster for r in spark.sql("SELECT id, cluster FROM scored").collect()}
    p = run.prepared
    exp = {r.id: r.cluster for r in assign(p.df, p.features, run.result.centroids).collect()}
    assert got == exp and len(got) > 900


def test_task_jobs_write_reference_outputs(spark, tmp_path):
    acc = str(tmp_path / "acc")
    write_csv(FX.accident_table(spark, SF_SMALL), acc, sep=";")
    out = str(tmp_path / "results")
    run_task(spark, 5, acc, out, points=True)
    run_task(spark, 6, acc, out, ks=[2, 12])
    cents = spark.read.option("header", "true").csv(os.path.join(out, "task5.csv"))
    assert cents.columns == ["X", "Y", "Day"] and cents.count() == 32
    el = spark.read.option("header", "true").csv(os.path.join(out, "task6.csv")).collect()
    assert [r.NumOfCluster for r in el] == ["2", "12"]
    pts = spark.read.option("header", "true").csv(os.path.join(out, "task5_clusteredPoints.csv"))
    assert pts.columns == ["Cluster", "X", "Y", "Day"] and pts.count() > 900


def test_geocode_file(spark, tmp_path):
    src = tmp_path / "c.csv"
    src.write_text("x,y,label\n385000,6672000,Helsinki\n500000,7000000\n")
    out = str(tmp_path / "g")
    geocode_file(spark, str(src), out)
    rows = sorted(spark.read.option("header", "true").csv(out).collect(), key=lambda r: r.LABEL)
    assert rows[0].LABEL.startswith("(27.0000000,") and rows[1].LABEL == "Helsinki"
    assert 24.9 < float(rows[1].LONGITUDE) < 25.0 and 60.1 < float(rows[1].LATITUDE) < 60.2
