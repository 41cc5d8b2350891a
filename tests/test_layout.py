"""Results must not depend on the number of cores."""

import json
import os
import subprocess
import sys

from tests.conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import json, sys
from tessera.session import local_session
spark = local_session(sys.argv[1], driver_memory="2g")
from tessera.operators.lloyd import assign
from tessera.plans import catalog as C, pipelines as PL
from tessera.sources import fixtures as FX
sf = sys.argv[2]
points = FX.accident_points(spark, sf)
rows = lambda df, *by: [list(r) for r in df.orderBy(*by).collect()]
r4 = lambda t: [[round(v, 4) if isinstance(v, float) else v for v in r] for r in t]
out = {
    "kmeans": r4(rows(PL.kmeans_centroids_2d(points, k=12), "cluster")),
    "elbow": r4(rows(PL.kmeans_elbow(points, 2, ks=(2, 12)), "NumOfCluster")),
    "lloyd": r4(rows(C.q_lloyd_elbow(spark, sf), "NumOfCluster")),
}
dirty = spark.createDataFrame([(1, 0.1, None), (2, float("nan"), 0.5), (3, 0.9, 0.9), (4, 0.0, 0.1)], "id long, a double, b double")
cents = [(0.0, 0.0), (1.0, 1.0)]
out["assign"] = [rows(assign(dirty, ["a", "b"], cents, method=m).select("id", "cluster"), "id") for m in ("jvm", "arrow")]
print("RESULT", json.dumps(out))
"""


def test_same_results_on_any_number_of_cores():
    found = []
    for cores in ("1", "2", "4"):
        run = subprocess.run([sys.executable, "-c", CODE, cores, SF_SMALL], cwd=ROOT, capture_output=True, text=True, timeout=900,
                             env=os.environ | {"PYTHONPATH": ROOT})
        assert "RESULT" in run.stdout, run.stderr[-2000:]
        found.append(json.loads(run.stdout.split("RESULT", 1)[1]))
    assert found[0] == found[1] == found[2]
    jvm, arrow = found[0]["assign"]
    assert jvm == arrow == [[1, None], [2, None], [3, 1], [4, 0]]
