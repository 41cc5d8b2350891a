import pytest
from pyspark.sql import functions as F

from tessera.sinks.csv import write_centroids, write_csv, write_elbow
from tessera.sources.delimited import parse_accident_lines, read_accidents, read_coordinates
from tessera.sources.schemas import ACCIDENT_FIELDS, ACCIDENT_SCHEMA, PARTY_SCHEMA, PERSON_SCHEMA, position_of
from tessera.sources.weekday import weekday_table


def test_schema_positions():
    assert len(ACCIDENT_FIELDS) == 102 and len(PERSON_SCHEMA) == 13 and len(PARTY_SCHEMA) == 13
    assert (position_of("Vkpv"), position_of("X"), position_of("Y")) == (19, 55, 56)
    assert ACCIDENT_SCHEMA["X"].dataType.typeName() == "double"


def _line(x="", y="", day="", ident="1"):
    f = [""] * 102
    f[0], f[19], f[55], f[56] = ident, day, x, y
    return ";".join(f)


def test_parse_lines_header_blank_and_junk(spark):
    header = ";".join(n for n, _ in ACCIDENT_FIELDS)
    lines = [header, _line("100", "200", "Maanantai"), _line("", "200", "Tiistai"),
             _line("abc", "5", "Torstai"), "short;line", header]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    rows = parse_accident_lines(df, id_pos=0).collect()
    assert len(rows) == 4  # both header lines dropped
    assert (rows[0].X, rows[0].Y, rows[0].Vkpv, rows[0].id) == (100.0, 200.0, "Maanantai", 1)
    assert rows[1].X is None and rows[2].X is None and rows[3].Y is None


def test_csv_roundtrip_multi_file(spark, tmp_path):
    rows = [tuple(None for _ in ACCIDENT_FIELDS)]
    df = spark.createDataFrame(rows * 0, ACCIDENT_SCHEMA)
    data = spark.range(50).select(*[
        (F.col("id").cast("int") if f.name == "Onnett_id" else
         (F.col("id") * 10.0) if f.name in ("X", "Y") else
         F.lit("Perjantai") if f.name == "Vkpv" else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in ACCIDENT_SCHEMA.fields]).repartition(4)
    p = str(tmp_path / "acc")
    write_csv(df.unionByName(data), p, sep=";")
    back = read_accidents(spark, p)
    assert back.count() == 50 and back.filter("Vkpv = 'Perjantai'").count() == 50
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<Vkpv:string,X:double,Y:double>" in plan  # pruned to 3 of 102


def test_coordinate_file(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text(" X , y ,label\n100,200, a \n300,400\n500\n\n600,700,,extra\n")
    rows = read_coordinates(spark, str(p)).collect()
    assert [(r.x, r.y, r.label) for r in rows] == [(100.0, 200.0, "a"), (300.0, 400.0, None), (600.0, 700.0, None)]
    bad = tmp_path / "bad.csv"
    bad.write_text("lat,lon\n1,2\n")
    with pytest.raises(ValueError):
        read_coordinates(spark, str(bad))


def test_weekday_table_and_sinks(spark, tmp_path):
    wk = weekday_table(spark)
    assert wk.count() == 7
    write_centroids(wk.withColumn("cluster", F.lit(1)), str(tmp_path / "c"), ["Vkpv", "dow_x"])
    back = spark.read.option("header", "true").csv(str(tmp_path / "c"))
    assert back.columns == ["Vkpv", "dow_x"] and back.count() == 7
    el = spark.createDataFrame([(12, 1.0, "sse"), (2, 5.0, "sse")], "NumOfCluster int, Cost double, metric string")
    write_elbow(el, str(tmp_path / "e"))
    got = spark.read.option("header", "true").csv(str(tmp_path / "e")).collect()
    assert [r.NumOfCluster for r in got] == ["2", "12"]


def test_columns_are_found_by_name(spark, tmp_path):
    from tessera.sources.delimited import read_accidents

    p = tmp_path / "swapped.csv"
    p.write_text("Vkpv;Y;other;X\nMaanantai;6700000;z;400000\n")
    assert [tuple(r) for r in read_accidents(spark, str(p)).collect()] == [(400000.0, 6700000.0, "Maanantai")]
    q = tmp_path / "lacking.csv"
    q.write_text("Vkpv;Y\nMaanantai;6700000\n")
    with pytest.raises(ValueError, match="no column X"):
        read_accidents(spark, str(q))


def test_every_coordinate_file_needs_its_header(spark, tmp_path):
    from tessera.sources.delimited import read_coordinates

    d = tmp_path / "many"
    d.mkdir()
    (d / "part-0.csv").write_text("X, y\n1,2\nabc,3\n,\n4,NaN\n")
    (d / "part-1.csv").write_text("x,y,label\n" + "5,6,seven\n" * 50)
    assert read_coordinates(spark, str(d)).count() == 51
    (d / "part-2.csv").write_text("8,9\n" * 500)
    with pytest.raises(ValueError, match="part-2"):
        read_coordinates(spark, str(d))
