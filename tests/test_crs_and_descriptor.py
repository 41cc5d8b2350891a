"""Coordinate systems, type inference, descriptors, one split a line."""

import json
import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import crs
from tessera.operators.geocode import tile_of_latlon, to_latlon, to_xy
from tessera.plans import oracle_sql as O
from tessera.sources import descriptor as D
from tessera.sources.delimited import parse_accident_lines
from tessera.sources.inference import infer_types, inferred_schema, read_inferred, text_fields
from tessera.sources.schemas import ACCIDENT_FIELDS


def _places(spark):
    rows = [(i, 59.8 + i * 0.5, 19.5 + (i * 7 % 12)) for i in range(21)]
    return spark.createDataFrame(rows, "id int, lat double, lon double")


def test_published_point_in_the_national_grid(spark):
    df = spark.createDataFrame([(60.3851068722, 19.84813676944)], "lat double, lon double")
    r = crs.transform(df, 4258, "EPSG:3067", "lat", "lon", ("x", "y")).first()
    assert abs(r.x - 106256.35961) < 0.001 and abs(r.y - 6715706.37708) < 0.001


def test_the_middle_of_utm_zones(spark):
    """On the meridian the easting is 500,000, and the northing of the equator 0."""
    for code, lon in ((32634, 21.0), (32635, 27.0), (32636, 33.0)):
        df = spark.createDataFrame([(0.0, lon), (60.0, lon)], "lat double, lon double")
        a, b = crs.transform(df, 4326, code, "lat", "lon", ("x", "y")).collect()
        assert abs(a.x - 500000) < 1e-6 and abs(a.y) < 1e-6 and abs(b.x - 500000) < 1e-6
        assert abs(b.y - 0.9996 * 6654072.819) < 0.01  # meridian arc to 60 degrees on WGS 84


@pytest.mark.parametrize("code", sorted(set(crs.CRS) - {4326}))
def test_there_and_back(spark, code):
    there = crs.transform(_places(spark), 4326, code, "lat", "lon", ("a", "b"))
    back = crs.transform(there, code, 4326, "a", "b", ("lat2", "lon2"))
    for r in back.collect():
        assert abs(r.lat2 - r.lat) < 5e-9 and abs(r.lon2 - r.lon) < 1.5e-8  # heights are not kept: under a millimetre


def test_datum_shift_against_plain_python(spark):
    """The seven parameters by hand, with the latitude found by iteration."""
    a, f = 6378388.0, 1 / 297.0
    e2 = f * (2 - f)
    got = {r.id: r for r in crs.transform(_places(spark), 4123, 4326, "lat", "lon", ("p", "l")).collect()}
    for r in _places(spark).collect():
        p, l = math.radians(r.lat), math.radians(r.lon)
        n = a / math.sqrt(1 - e2 * math.sin(p) ** 2)
        x, y, z = n * math.cos(p) * math.cos(l), n * math.cos(p) * math.sin(l), n * (1 - e2) * math.sin(p)
        dx, dy, dz, rx, ry, rz, s = crs.KKJ_TO_WGS84
        rx, ry, rz, m = *(math.radians(v / 3600) for v in (rx, ry, rz)), 1 + s * 1e-6
        x, y, z = dx + m * (x - rz * y + ry * z), dy + m * (rz * x + y - rx * z), dz + m * (-ry * x + rx * y + z)
        a2, f2 = 6378137.0, 1 / 298.257223563
        w2 = f2 * (2 - f2)
        d = math.hypot(x, y)
        lat = math.atan2(z, d * (1 - w2))
        for _ in range(20):
            lat = math.atan2(z + w2 * a2 / math.sqrt(1 - w2 * math.sin(lat) ** 2) * math.sin(lat), d)
        assert abs(got[r.id].p - math.degrees(lat)) < 1e-9 and abs(got[r.id].l - math.degrees(math.atan2(y, x))) < 1e-9
        # the two datums differ by some 150 to 250 m in Finland
        away = math.hypot((got[r.id].p - r.lat) * 111e3, (got[r.id].l - r.lon) * 111e3 * math.cos(p))
        assert 50 < away < 400


def test_src_and_dst_of_the_operators(spark):
    grid = to_xy(_places(spark))
    old = to_latlon(grid, "x", "y", "n", "e", dst="epsg:2393")
    assert old.where("n NOT BETWEEN 3000000 AND 4000000").count() == 0
    again = to_xy(old, "n", "e", "x2", "y2", src="EPSG:2393")
    assert again.where("abs(x2 - x) > 0.001 OR abs(y2 - y) > 0.001").count() == 0
    tiles = {r.id: r.tile for r in tile_of_latlon(old, "n", "e", src="epsg:2393").collect()}
    assert tiles == {r.id: r.tile for r in tile_of_latlon(_places(spark)).collect()}


def test_unknown_systems_nulls_and_clashing_names(spark):
    with pytest.raises(ValueError):
        to_xy(_places(spark), src="epsg:9999")
    df = spark.createDataFrame([(None, 1.0, "p", 2.0), (60.0, 25.0, "q", 3.0)], "lat double, lon double, _p string, _row double")
    rows = {r._p: r for r in crs.transform(df, 4326, 2392, "lat", "lon", ("lat", "x")).collect()}
    assert rows["p"].lat is None and rows["q"]._row == 3.0 and rows["q"].lat > 2.4e6 and len(rows["q"]) == 5


def test_anchors_hold_the_points_of_their_tiles(spark):
    """Library and twin both, against points and not each other."""
    import duckdb

    from tessera.operators import tiles as T
    pts = spark.createDataFrame([(i, 120000.0 + (i * 7919) % 550000, 6630000.0 + (i * 104729) % 1100000) for i in range(200)], "id int, X double, Y double")
    con = duckdb.connect()
    for level in (0, 3, 6, 8, 9):
        own = T.describe(T.with_tile(pts, level=level), "tile", ("sw",)).collect()
        for r in own:
            assert r.anchor_x <= r.X < r.anchor_x + r.width and r.anchor_y <= r.Y < r.anchor_y + r.height
        sw, ne = O.anchor_sql("t", "sw"), O.anchor_sql("t", "ne")
        for r in own[:40]:
            x, y, x2, y2 = con.execute(f"SELECT {sw[0]}, {sw[1]}, {ne[0]}, {ne[1]} FROM (SELECT ? AS t)", [r.tile]).fetchone()
            assert x <= r.X < x2 and y <= r.Y < y2


def test_types_are_the_greatest_of_their_fields(spark, tmp_path):
    text = "a;b;c;d;e;f;g\n1; 2 ;3000000000;1.5;x;;12\n-7;;4;1e3;2;;1d\n+0;5;5;7;;; \n"
    (tmp_path / "t.csv").write_text(text)
    rows = infer_types(text_fields(spark, str(tmp_path / "t.csv"))).collect()
    assert [(r.name, r.type, r.n_null, r.width) for r in rows] == [
        ("a", "integer", 0, 2), ("b", "integer", 1, 1), ("c", "bigint", 0, 10), ("d", "double", 0, 3),
        ("e", "string", 1, 1), ("f", "null", 3, 0), ("g", "string", 1, 2)]
    assert all(r.n_rows == 3 for r in rows)
    df = read_inferred(spark, str(tmp_path / "t.csv"))
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["int", "int", "bigint", "double", "string", "string", "string"]
    assert df.agg(F.sum("a"), F.sum("b"), F.sum("c"), F.sum("d")).first()[:] == (-6, 7, 3000000009, 1008.5)


def test_types_of_empty_files(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a;b\n")
    report = infer_types(text_fields(spark, str(tmp_path / "t.csv")))
    assert [(r.type, r.n_rows) for r in report.collect()] == [("null", 0), ("null", 0)]
    assert inferred_schema(report).simpleString() == "struct<a:string,b:string>"


def test_descriptor_round_trip_and_errors():
    tables = D.parse(D.render([D.ACCIDENT, D.PARTY, D.PERSON]))
    assert [t.name for t in tables.values()] == ["accident", "party", "person"] and len(tables["accident"].schema) == 102
    assert tables["party"].parents == D.PARTY.parents and tables["person"].key == D.PERSON.key
    bad = json.loads(D.render([D.ACCIDENT, D.PARTY]))
    bad["resources"][1]["schema"]["foreignKeys"][0]["reference"]["resource"] = "nowhere"
    with pytest.raises(ValueError):
        D.parse(json.dumps(bad))
    bad = json.loads(D.render([D.ACCIDENT]))
    bad["resources"][0]["schema"]["primaryKey"] = "nothing"
    with pytest.raises(ValueError):
        D.parse(json.dumps(bad))


def test_described_rows_and_checks(spark, tmp_path):
    text = {"resources": [
        {"name": "p", "path": "p", "schema": {"fields": [{"name": "k", "type": "integer"}, {"name": "v", "type": "any"}], "primaryKey": "k"}},
        {"name": "c", "path": "c", "dialect": {"delimiter": ","}, "schema": {
            "fields": [{"name": "i", "type": "integer"}, {"name": "k", "type": "integer"}, {"name": "w", "type": "number"}], "primaryKey": ["i"],
            "foreignKeys": [{"fields": "k", "reference": {"resource": "p", "fields": "k"}}]}}]}
    for name, body in (("p", "k;v\n1;a\n2;b\n2;c\n;d\n"), ("c", "i,k,w\n1,1,0.5\n2,3,\n2,,1\n,2,2\n")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.csv").write_text(body)
    (tmp_path / "d.json").write_text(json.dumps(text))
    tables = D.read_descriptor(spark, str(tmp_path / "d.json"))
    got = {r.table: r[1:] for r in D.check(spark, tables, str(tmp_path)).collect()}
    assert got == {"p": (4, 1, 1, 0), "c": (4, 1, 1, 1)}
    assert D.read_described(spark, tables["c"], str(tmp_path)).schema.simpleString() == "struct<i:int,k:int,w:double>"


def test_lines_are_split_once(spark):
    line = ";".join(str(i) for i in range(len(ACCIDENT_FIELDS)))
    df = spark.createDataFrame([(line,), (";".join(n for n, _ in ACCIDENT_FIELDS),), (None,), ("",)], "value string")
    parsed = parse_accident_lines(df, id_pos=0).where("X IS NOT NULL AND Vkpv IS NOT NULL")
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    r = parsed.collect()
    assert len(r) == 1 and (r[0].id, r[0].X, r[0].Y, r[0].Vkpv) == (0, 55.0, 56.0, "19")
    assert parse_accident_lines(df).count() == 3
