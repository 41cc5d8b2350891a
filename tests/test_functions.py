import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions.cyclic import DAY_POINTS, WEEKDAY_NAMES, decode_day, encode_day_number
from tessera.functions.projection import latlon_to_xy, xy_to_latlon
from tessera.functions.scaling import minmax_scale, minmax_unscale
from tessera.functions.tiles import (LEVEL_SIZES, inside_grid, tile_anchor, tile_level, tile_of_xy,
                                     tile_rollup, tile_size)


def test_weekday_points_on_circle():
    assert len(DAY_POINTS) == 7 and WEEKDAY_NAMES[0] == "Maanantai"
    for x, y in DAY_POINTS:
        assert abs(x * x + y * y - 1) < 1e-12
    assert DAY_POINTS[6] == (1.0, 0.0)  # Sunday: full turn, sine exactly 0


def test_decode_encode_roundtrip(spark):
    df = spark.range(0, 10).select(F.col("id").cast("int").alias("d"))
    x, y = encode_day_number("d")
    out = {r["d"]: r["dow"] for r in df.select("d", decode_day(x, y).alias("dow")).collect()}
    for d in range(1, 8):
        assert out[d] == pytest.approx(d, abs=1e-12)
    assert out[0] is None and out[8] is None  # out of range -> null


def test_decode_range_and_null(spark):
    df = spark.createDataFrame([(1.0, -1e-300), (-1.0, 0.0), (None, 1.0)], "x double, y double")
    vals = [r[0] for r in df.select(decode_day("x", "y")).collect()]
    assert 0 < vals[0] <= 7 and vals[1] == pytest.approx(3.5) and vals[2] is None


@settings(max_examples=25, deadline=None)
@given(st.lists(st.floats(-1e7, 1e7, allow_nan=False), min_size=2, max_size=20))
def test_unscale_scale_identity(spark, values):
    lo, hi = min(values), max(values)
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select("v", minmax_unscale(minmax_scale("v", lo, hi), lo, hi).alias("b"),
                     minmax_scale("v", lo, hi).alias("s")).collect()
    for r in rows:
        assert r["b"] == pytest.approx(r["v"], rel=1e-9, abs=1e-6)
        assert -1e-12 <= r["s"] <= 1 + 1e-12


def test_zero_range_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "v double")
    assert [r[0] for r in df.select(minmax_scale("v", 5.0, 5.0)).collect()] == [0.0, 0.0, None]


def test_projection_known_point(spark):
    df = spark.createDataFrame([(60.3851068722, 19.84813676944)], "lat double, lon double")
    x, y = latlon_to_xy("lat", "lon")
    r = df.select(x.alias("x"), y.alias("y")).first()
    assert r["x"] == pytest.approx(106256.360, abs=2e-3)
    assert r["y"] == pytest.approx(6715706.377, abs=2e-3)


def test_projection_roundtrip_within_mm(spark):
    pts = [(float(x), float(y)) for x in range(60000, 760001, 35000) for y in range(6600000, 7800001, 60000)]
    df = spark.createDataFrame(pts, "x double, y double")
    lat, lon = xy_to_latlon("x", "y")
    ll = df.select("x", "y", lat.alias("lat"), lon.alias("lon"))
    bx, by = latlon_to_xy("lat", "lon")
    for r in ll.select("x", "y", "lat", "lon", bx.alias("bx"), by.alias("by")).collect():
        assert abs(r["bx"] - r["x"]) < 1e-3 and abs(r["by"] - r["y"]) < 1e-3
        assert 59 < r["lat"] < 72 and 15 < r["lon"] < 39


def test_rollup_of_named_tile(spark):
    df = spark.createDataFrame([("L4113H3",)], "t string")
    names = df.select(tile_rollup("t")).first()[0]
    assert names == ["L4", "L4L", "L41", "L41L", "L411", "L411R", "L4113", "L4113R", "L4113H", "L4113H3"]
    lv = spark.createDataFrame([(n,) for n in names], "t string").select(tile_level("t")).collect()
    assert [r[0] for r in lv] == list(range(10))


@pytest.mark.parametrize("name,level", [
    ("KL", -1), ("L", -1), ("L4113H3X", -1), ("O4", -1), ("L7", -1), ("L4113AR", -1),
    ("L45", -1), ("L4113I", -1), ("K2", 0), ("X6R", 1), ("L4113E", 8), (None, None)])
def test_tile_level_malformed(spark, name, level):
    df = spark.createDataFrame([(name,)], "t string")
    w, h = tile_size("t")
    r = df.select(tile_level("t").alias("lv"), w.alias("w"), h.alias("h")).first()
    assert r["lv"] == level
    if level is not None and level >= 0:
        assert (r["w"], r["h"]) == LEVEL_SIZES[level]
    else:
        assert r["w"] is None


def test_tile_anchor_inverts_tile_of_xy(spark):
    pts = [(float(x), float(y)) for x in range(-76000, 884000, 41017) for y in range(6570500, 7817000, 77777)]
    df = spark.createDataFrame(pts, "x double, y double").withColumn("t", tile_of_xy("x", "y"))
    ax, ay = tile_anchor("t", "sw")
    cx, cy = tile_anchor("t", "c")
    rows = df.select("x", "y", "t", inside_grid("x", "y").alias("inside"), ax.alias("ax"), ay.alias("ay"),
                     cx.alias("cx"), cy.alias("cy")).collect()
    seen = 0
    for r in rows:
        assert (r["t"] is not None) == r["inside"]
        if r["t"] is None:
            continue
        seen += 1
        assert r["ax"] <= r["x"] < r["ax"] + 3000 and r["ay"] <= r["y"] < r["ay"] + 3000
        assert (r["cx"], r["cy"]) == (r["ax"] + 1500, r["ay"] + 1500)
    assert seen > 50
    again = df.filter("t is not null").select("t", ax.alias("ax"), ay.alias("ay"))
    back = again.select("t", tile_of_xy("ax", "ay").alias("t2")).collect()
    assert all(r["t"] == r["t2"] for r in back)


def test_tile_outside_grid_is_null(spark):
    df = spark.createDataFrame([(0.0, 6000000.0), (-500000.0, 7000000.0), (300000.0, 9e6)], "x double, y double")
    assert [r[0] for r in df.select(tile_of_xy("x", "y")).collect()] == [None, None, None]


def test_half_tile_anchor(spark):
    # L4R is the eastern half of L4: its south-west corner is 96 km east of L4's
    df = spark.createDataFrame([("L4",), ("L4R",), ("L41L",)], "t string")
    ax, _ = tile_anchor("t", "sw")
    xs = [r[0] for r in df.select(ax).collect()]
    assert xs[1] - xs[0] == 96000 and xs[2] == xs[0]
    assert math.isclose(xs[0], -460000 + 4 * 192000)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.floats(-76000, 883999), st.floats(6570000, 7817999)), min_size=1, max_size=30))
def test_tile_roundtrip_property(spark, pts):
    """For any point in the grid: its level-9 tile's sw corner lies at most
    one 3 km cell below/left of it, and every roll-up level parses as itself."""
    df = spark.createDataFrame(pts, "x double, y double").withColumn("t", tile_of_xy("x", "y"))
    ax, ay = tile_anchor("t", "sw")
    rows = df.select("x", "y", "t", ax.alias("ax"), ay.alias("ay"), tile_rollup("t").alias("r")).collect()
    for r in rows:
        if r.t is None:
            continue
        assert r.ax <= r.x < r.ax + 3000 and r.ay <= r.y < r.ay + 3000
        lv = spark.createDataFrame([(n,) for n in r.r], "n string").select(tile_level("n")).collect()
        assert [v[0] for v in lv] == list(range(10))
