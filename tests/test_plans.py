"""Physical-plan properties that matter at scale, checked on every lazily
built catalog query: no cross joins, pruned scans, pushed null filters,
Python only where the assignment kernel is meant to run."""

import re

import pytest

from tessera.plans import catalog
from tests.conftest import SF_SMALL

# Queries that run their iterations eagerly while being built (covered by the
# catalog tests instead).
EAGER = {"kmeans_2d", "kmeans_4d", "kmeans_elbow_2d", "kmeans_elbow_4d", "lloyd_elbow", "lloyd_pipeline",
         "lloyd_fixed_iters", "centroid_shift", "lloyd_labelled_points"}
ARROW_KERNEL = {"nearest_centroid", "lloyd_step"}


def _plan(spark, name):
    df = catalog.QUERIES[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - EAGER))
def test_plan_shape(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    python = bool(re.search(r"ArrowEvalPython|BatchEvalPython", plan))
    assert python == (name in ARROW_KERNEL)
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        if "events" in plan and "embedding" not in schema:
            assert schema.count(":") <= 4, schema  # never the whole table


def test_events_scans_push_null_filters(spark):
    plan = _plan(spark, "tile_of_point")
    assert "PushedFilters: [IsNotNull(event_id)]" in plan
    assert "ReadSchema: struct<event_id:bigint>" in plan


def test_weekday_table_is_local(spark):
    plan = _plan(spark, "weekday_dim_join")
    assert "BroadcastHashJoin" in plan and "LocalTableScan" in plan
    assert "ExistingRDD" not in plan  # no Python RDD behind the 7 rows
