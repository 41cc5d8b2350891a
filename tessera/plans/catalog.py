"""The query catalog: one Spark query per operator group, each with a SQL
twin (``ORACLE``) where the semantics are expressible in SQL.

Each query takes ``(spark, sf_dir)`` and reads the whole of the driver's
tables. Doubles that depend on summation order are rounded (both sides) so
engines agree; exact arithmetic (scaling, tile indices) is compared as is
or with generous rounding.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.cyclic import day_number_of_name, decode_day, weekday_number
from tessera.functions.tiles import ANCHORS, tile_of_xy, tile_rollup
from tessera.operators import tiles as tile_ops
from tessera.operators.clean import complete_rows, reject_counts
from tessera.operators.cost import cluster_sse, sum_distance_to_mean, total_sse
from tessera.operators.elbow import DEFAULT_KS
from tessera.operators.geocode import geocode, tile_of_latlon, to_latlon, to_xy
from tessera.operators.kmeans_ml import fit_facts, member_centroids
from tessera.operators import centroid_index
from tessera.operators.dedupe import seen_positions
from tessera.operators.lloyd import assign, lloyd, sample_seeds, seed_centroids, update_stats
from tessera.operators.kmeans_pipeline import differing_labels, fit_pipeline, learned_range, load_pipeline, save_pipeline, scaled_features, score
from tessera.operators.lloyd_bounded import lloyd_bounded
from tessera.operators.preview import preview
from tessera.operators.scale import extremes, fit_minmax, scale, unscale
from tessera.operators.weekday import attach_weekday, decode_weekday, encode_weekday
from tessera.plans import oracle_sql as O
from tessera.plans import pipelines as PL
from tessera.session import scratch_path
from tessera.sinks.csv import write_centroids, write_csv, write_elbow, write_geocoded, write_points
from tessera.functions.crs import transform
from tessera.sources import descriptor
from tessera.sources import fixtures as FX
from tessera.sources.inference import infer_types, read_inferred
from tessera.sources.local import literal_table
from tessera.sources.delimited import (
    coordinate_reject_counts, parse_accident_lines, read_accident_lines, read_accidents, read_coordinates)

Query = Callable[[SparkSession, str], DataFrame]

LLOYD_K = 32          # default number of clusters of the Lloyd task
LLOYD_SEED = 0
LLOYD_TOL = 1.5       # Σ centroid movement (scaled units) that ends the run
LLOYD_MAX_ITER = 200
FIXED_PASSES = 5      # passes of the fixed-iteration variants
ELBOW_TOL = 2.0
ELBOW_MAX_ITER = 50
CSV_ELBOW_KS = (2, 12)


def _r(c, d: int = 6):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


def _points(spark, sf, with_type=False):
    return FX.accident_points(spark, sf, with_type=with_type)


def _prep2(spark, sf):
    clean = complete_rows(_points(spark, sf, True), ["X", "Y"])
    mm = fit_minmax(clean, ["X", "Y"])
    return scale(clean, mm), mm


def _prep4(spark, sf):
    enc = attach_weekday(_points(spark, sf, True))
    clean = complete_rows(enc, ["X", "Y", "dow_x", "dow_y"])
    mm = fit_minmax(clean, ["X", "Y", "dow_x", "dow_y"])
    return scale(clean, mm), mm


def _prep_lloyd(spark, sf):
    return PL.prepare_lloyd(_points(spark, sf))


# ---------------------------------------------------------------- sources

def q_points_clean(spark, sf):
    pts = _points(spark, sf)
    return complete_rows(pts, ["X", "Y", "Vkpv"]).select("id", "X", "Y", "Vkpv")


def q_raw_line_parse(spark, sf):
    parsed = parse_accident_lines(FX.accident_lines(spark, sf), id_pos=0)
    return complete_rows(parsed, ["X", "Y", "Vkpv"]).select("id", "X", "Y", "Vkpv")


def q_raw_line_scan(spark, sf):
    path = scratch_path(spark, "accident-lines")
    FX.accident_lines(spark, sf).write.text(path)
    parsed = read_accident_lines(spark, path)
    return complete_rows(parsed, ["X", "Y", "Vkpv"]).select("id", "X", "Y", "Vkpv")


def q_csv_roundtrip_scan(spark, sf):
    path = scratch_path(spark, "accidents-csv")
    accidents = FX.accident_table(spark, sf)
    write_csv(accidents.select(*reversed(accidents.columns)), path, sep=";")  # columns are found by name
    df = read_accidents(spark, path, columns=("Onnett_id", "X", "Y", "Vkpv"))
    return complete_rows(df, ["X", "Y", "Vkpv"]).select(
        F.col("Onnett_id").cast("bigint").alias("id"), "X", "Y", "Vkpv")


def q_coordinate_csv_scan(spark, sf):
    path = scratch_path(spark, "coords-csv")
    FX.coordinate_lines(spark, sf).write.text(path)
    return read_coordinates(spark, path).select("x", "y", "label")


def q_infer_types(spark, sf):
    """Type, nulls and width of each of the 102 columns of written files."""
    path = scratch_path(spark, "accident-files")
    FX.accident_lines(spark, sf, with_header=False).write.text(path)
    names = [f.name for f in descriptor.ACCIDENT.schema.fields]
    plain = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return infer_types(spark.read.schema(plain).options(sep=";", header="false").csv(path))


def q_read_inferred(spark, sf):
    """Files with a header, read with the types their fields allow."""
    path = scratch_path(spark, "inferred-csv")
    pts = FX.accident_points(spark, sf)
    write_csv(pts.select("id", F.expr("CAST(X AS STRING)").alias("X"), F.expr("CAST(Y AS BIGINT)").alias("Y"), "Vkpv"), path, sep=";")
    df = read_inferred(spark, path)
    kinds = ",".join(f.dataType.simpleString() for f in df.schema.fields)
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("id").cast("bigint")).alias("sum_id"), F.sum(F.nanvl("X", F.lit(0.0))).alias("sum_x"),
                  F.sum(F.col("Y").cast("bigint")).alias("sum_y"), F.lit(kinds).alias("kinds"))


def q_described_tables(spark, sf):
    """Three tables written with their descriptor, read by it and checked."""
    base = scratch_path(spark, "described")
    for name, df in FX.described_tables(spark, sf).items():
        write_csv(df, f"{base}/{name}", sep=";")
    text = descriptor.render([descriptor.ACCIDENT, descriptor.PARTY, descriptor.PERSON])
    literal_table(spark, [(text,)], T.StructType([T.StructField("value", T.StringType())])).coalesce(1).write.text(f"{base}/descriptor")
    return descriptor.check(spark, descriptor.read_descriptor(spark, f"{base}/descriptor"), base)


def q_coordinate_rejects(spark, sf):
    return coordinate_reject_counts(FX.coordinate_lines(spark, sf))


def q_dirty_reject_counts(spark, sf):
    enc = attach_weekday(_points(spark, sf))
    return reject_counts(enc, ["X", "Y", "dow_x", "dow_y"])


def q_weekday_dim_join(spark, sf):
    nothing = F.lit(None).cast("double")
    return attach_weekday(_points(spark, sf)).select("id", F.nanvl("X", nothing).alias("X"), "Y", "dow_x", "dow_y")


def q_weekday_cyclic_decode(spark, sf):
    enc = attach_weekday(_points(spark, sf).withColumn("name", F.col("Vkpv")))
    return enc.select("id", "name", _r(decode_day("dow_x", "dow_y"), 9).alias("dow"))


def q_weekday_number_round_trip(spark, sf):
    """Weekday by number, no join, and back; with the number of the name."""
    ev = FX.table(spark, sf, "events").select("event_id", weekday_number("ts").alias("day"))
    both = decode_weekday(encode_weekday(ev, "day")).join(
        _points(spark, sf).select("id", day_number_of_name("Vkpv").alias("named")), F.col("event_id") == F.col("id"))
    return both.select("id", "day", "named", _r("dow", 9).alias("dow"))


# ---------------------------------------------------------------- scaling

def q_extremes_2d(spark, sf):
    return extremes(complete_rows(_points(spark, sf), ["X", "Y"]), ["X", "Y"])


def q_extremes_4d(spark, sf):
    enc = complete_rows(attach_weekday(_points(spark, sf)), ["X", "Y", "dow_x", "dow_y"])
    return extremes(enc, ["X", "Y", "dow_x", "dow_y"])


def q_minmax_scale(spark, sf):
    df, _ = _prep4(spark, sf)
    return df.select("id", *[_r(c, 12).alias(c) for c in PL.FEATURES_4D])


_LI_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def q_minmax_scale_lineitem(spark, sf):
    li = FX.table(spark, sf, "lineitem")
    clean = complete_rows(li, _LI_COLS)
    mm = fit_minmax(clean, _LI_COLS)
    out = scale(clean, mm, _LI_COLS)
    return out.select("l_orderkey", "l_linenumber", *[_r(f"{c}_scaled", 12).alias(f"{c}_scaled") for c in _LI_COLS])


def q_minmax_unscale(spark, sf):
    li = FX.table(spark, sf, "lineitem")
    clean = complete_rows(li, _LI_COLS)
    mm = fit_minmax(clean, _LI_COLS)
    back = unscale(scale(clean, mm, _LI_COLS), mm, {f"{c}_scaled": f"{c}_back" for c in _LI_COLS})
    return back.select("l_orderkey", "l_linenumber", *[_r(f"{c}_back", 6).alias(f"{c}_back") for c in _LI_COLS])


# ---------------------------------------------------------------- group summaries and costs

def q_group_centroids_2d(spark, sf):
    df, mm = _prep2(spark, sf)
    c = member_centroids(df, mm, {"X_scaled": "x", "Y_scaled": "y"}, label="event_type")
    return c.select("cluster", "n", _r("x").alias("x"), _r("y").alias("y"))


def q_group_centroids_4d(spark, sf):
    df, mm = _prep4(spark, sf)
    c = member_centroids(df, mm, {"X_scaled": "x", "Y_scaled": "y", "dow_x_scaled": "dow_x",
                                  "dow_y_scaled": "dow_y"}, label="event_type")
    c = c.withColumn("dow", decode_day("dow_x", "dow_y"))
    return c.select("cluster", "n", *[_r(k).alias(k) for k in ("x", "y", "dow_x", "dow_y", "dow")])


def q_group_centroids_nd(spark, sf):
    """Mean vector per group, one row a position, whatever the vectors' length."""
    emb = FX.table(spark, sf, "embeddings")
    each = emb.select("label", F.posexplode("embedding").alias("pos", "e"))
    return each.groupBy("label", "pos").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("e").cast("double")), 6).alias("avg_e"))


def q_cost_l2_sum_2d(spark, sf):
    df, _ = _prep2(spark, sf)
    return sum_distance_to_mean(df, PL.FEATURES_2D, "event_type").select(_r("cost", 6).alias("cost"))


def q_cost_l2_sum_4d(spark, sf):
    df, _ = _prep4(spark, sf)
    return sum_distance_to_mean(df, PL.FEATURES_4D, "event_type").select(_r("cost", 6).alias("cost"))


def q_cost_sse(spark, sf):
    df, _ = _prep4(spark, sf)
    s = cluster_sse(df, PL.FEATURES_4D, "event_type")
    return s.select("event_type", "n", *[_r(f, 8).alias(f) for f in PL.FEATURES_4D], _r("sse", 6).alias("sse"))


def q_cost_sse_total(spark, sf):
    df, _ = _prep4(spark, sf)
    return total_sse(df, PL.FEATURES_4D, "event_type").select(_r("sse", 6).alias("sse"))


# ---------------------------------------------------------------- Lloyd

def q_sample_seeds(spark, sf):
    p = _prep_lloyd(spark, sf)
    s = sample_seeds(p.df, p.features, LLOYD_K, LLOYD_SEED)
    return s.select("idx", "id", *[_r(f, 12).alias(f) for f in p.features])


def q_nearest_centroid(spark, sf):
    p = _prep_lloyd(spark, sf)
    seeds = seed_centroids(p.df, p.features, LLOYD_K, LLOYD_SEED)
    return assign(p.df, p.features, seeds).select("id", "cluster")


def q_lloyd_step(spark, sf):
    p = _prep_lloyd(spark, sf)
    seeds = seed_centroids(p.df, p.features, LLOYD_K, LLOYD_SEED)
    st = update_stats(assign(p.df, p.features, seeds), p.features)
    return st.select("cluster", "n", *[_r(f, 8).alias(f) for f in p.features], _r("sse", 6).alias("sse"))


INDEXED_K, INDEXED_LLOYD_K, INDEXED_PASSES = 10_000, 500, 3
BOUNDED_PASSES = 20


def _line_places(spark, sf):
    """(idx, features) of INDEXED_K places made from lines' keys, in md5 order."""
    key = F.col("id")
    lines = FX.table(spark, sf, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id")).distinct()
    values = [(key * 7919 % 100003) / F.lit(100003.0), (key * 104729 % 100019) / F.lit(100019.0), (key * 31 % 2003) / F.lit(1001.5) - 1.0, (key * 17 % 1999) / F.lit(999.5) - 1.0]
    return lines.select(key, *[v.alias(f) for v, f in zip(values, PL.FEATURES_LLOYD)])


def q_nearest_centroid_indexed(spark, sf):
    """Nearest of 10,000 centroids that stay in a written, indexed table."""
    p = _prep_lloyd(spark, sf)
    index = centroid_index.build(sample_seeds(_line_places(spark, sf), p.features, INDEXED_K, LLOYD_SEED), p.features)
    return centroid_index.assign_indexed(p.df, p.features, index).select("id", "cluster")


def q_lloyd_indexed_steps(spark, sf):
    p = _prep_lloyd(spark, sf)
    res = lloyd(p.df, p.features, k=INDEXED_LLOYD_K, tol=0.0, max_iter=INDEXED_PASSES - 1, seed=LLOYD_SEED, method="index")
    return _lloyd_frame(PL.LloydRun(p, res))


def q_lloyd_bounded(spark, sf):
    """Lloyd with bounds: the centroids of the plain run, from fewer distances."""
    p = _prep_lloyd(spark, sf)
    res = lloyd_bounded(p.df, p.features, k=LLOYD_K, tol=0.0, max_iter=BOUNDED_PASSES - 1, seed=LLOYD_SEED)
    frame = _lloyd_frame(PL.LloydRun(p, res))
    return frame.select("*", F.lit(3 * res.distances < res.exhaustive).alias("under_third"))


def _lloyd_frame(run: PL.LloydRun) -> DataFrame:
    c = run.centroids()
    return c.select("cluster", "n", _r("X", 4).alias("X"), _r("Y", 4).alias("Y"), _r("Day", 6).alias("Day"))


def q_lloyd_fixed_iters(spark, sf):
    p = _prep_lloyd(spark, sf)
    res = lloyd(p.df, p.features, k=LLOYD_K, tol=0.0, max_iter=FIXED_PASSES - 1, seed=LLOYD_SEED)
    return _lloyd_frame(PL.LloydRun(p, res))


def q_centroid_shift(spark, sf):
    p = _prep_lloyd(spark, sf)
    res = lloyd(p.df, p.features, k=LLOYD_K, tol=0.0, max_iter=FIXED_PASSES - 1, seed=LLOYD_SEED)
    rows = [(int(i), float(s), float(e)) for i, s, e in res.history]
    df = literal_table(spark, rows, T.StructType([T.StructField("pass", T.IntegerType()),
                                                  T.StructField("shift", T.DoubleType()),
                                                  T.StructField("sse", T.DoubleType())]))
    return df.select("pass", _r("shift", 6).alias("shift"), _r("sse", 6).alias("sse"))


def q_lloyd_pipeline(spark, sf):
    run = PL.lloyd_run(_points(spark, sf), k=LLOYD_K, tol=LLOYD_TOL, max_iter=LLOYD_MAX_ITER, seed=LLOYD_SEED)
    return _lloyd_frame(run)


def q_lloyd_labelled_points(spark, sf):
    run = PL.lloyd_run(_points(spark, sf), k=LLOYD_K, tol=LLOYD_TOL, max_iter=LLOYD_MAX_ITER, seed=LLOYD_SEED)
    lab = run.labelled_points()
    return lab.select("id", "Cluster", "X", "Y", _r("Day", 6).alias("Day"))


def q_lloyd_elbow(spark, sf):
    e = PL.lloyd_elbow(_points(spark, sf), ks=DEFAULT_KS, tol=ELBOW_TOL, max_iter=ELBOW_MAX_ITER, seed=LLOYD_SEED)
    return e.select("NumOfCluster", _r("Cost", 4).alias("Cost"), "metric")


# ---------------------------------------------------------------- MLlib k-means
#
# k-means|| draws at random, so SQL cannot give the centroids themselves. The
# queries run the whole fit and return what any right result must satisfy.

KMEANS_K = {2: 300, 4: 100}


def _kmeans_facts(spark, sf, dims: int):
    cents, (n, assigned, off, within, _) = PL.kmeans_checked(_points(spark, sf), dims, KMEANS_K[dims])
    sums = cents.agg(
        F.sum("n").alias("sum_n"),
        *[F.round(F.sum(F.col("n") * F.col(c)), 0).cast("bigint").alias(f"sum_{c}") for c in ("x", "y")],
        *[F.round(F.sum(F.col("n") * F.col(c)), 4).alias(f"sum_{c}") for c in ("dow_x", "dow_y") if dims == 4])
    return sums.select(
        F.lit(n).cast("bigint").alias("n_rows"), F.lit(assigned).cast("bigint").alias("n_assigned"),
        F.lit(off).cast("bigint").alias("n_off_nearest"), F.lit(within).alias("within_k"), "*")


def q_kmeans_2d(spark, sf):
    return _kmeans_facts(spark, sf, 2)


def q_kmeans_4d(spark, sf):
    return _kmeans_facts(spark, sf, 4)


def q_kmeans_reloaded(spark, sf):
    """A fitted pipeline saved and loaded: its labels of the raw points against
    the fit's, and the extremes it learned."""
    features, k = ["X", "Y", "dow_x", "dow_y"], KMEANS_K[4]
    points = attach_weekday(_points(spark, sf)).select("id", *features)
    fitted = fit_pipeline(points, features, k)
    path = scratch_path(spark, "kmeans-model")
    save_pipeline(fitted, path)
    loaded = load_pipeline(path)
    facts = fit_facts(loaded.stages[-1], scaled_features(loaded, points), [f"{f}_scaled" for f in features], k)
    learned = learned_range(loaded)
    return differing_labels(score(fitted, points), score(loaded, points)).select(
        "*", F.lit(facts[2]).cast("bigint").alias("n_off_nearest"), F.lit(facts[3]).alias("within_k"),
        *[F.lit(round(v, 9)).alias(f"{end}_{f}") for f in features for end, v in (("lo", learned.lo(f)), ("hi", learned.hi(f)))])


def q_csv_geocoded_file(spark, sf):
    """Geocoded centroids as one plain file, written twice over."""
    path = scratch_path(spark, "csv-geocoded-file") + ".csv"
    for _ in range(2):
        write_geocoded(geocode(_labelled_centroids(spark, sf)), path, one_file=True)
    back = _read_back(spark, path, "LONGITUDE double, LATITUDE double, LABEL string")
    one = back.select("*", F.col("_metadata.file_name").alias("file"))
    return one.select(_r("LONGITUDE", 7).alias("LONGITUDE"), _r("LATITUDE", 7).alias("LATITUDE"), "LABEL",
                      F.lit(path).endswith(F.concat(F.lit("/"), "file")).alias("named"))


def q_sample_seeds_many(spark, sf):
    """As many seeds as the largest model of an elbow has."""
    p = _prep_lloyd(spark, sf)
    return sample_seeds(p.df, p.features, max(DEFAULT_KS), LLOYD_SEED).select("idx", "id")


def _elbow_facts(spark, sf, dims: int):
    e = PL.kmeans_elbow(_points(spark, sf), dims=dims, ks=DEFAULT_KS, facts=True)
    return e.select("NumOfCluster", "metric", "n_rows", "n_assigned", "n_off_nearest", "within_k",
                    F.expr("Cost > 0 AND abs(Cost - cost_again) <= 1e-6 * Cost").alias("cost_ok"))


def q_kmeans_elbow_2d(spark, sf):
    return _elbow_facts(spark, sf, 2)


def q_kmeans_elbow_4d(spark, sf):
    return _elbow_facts(spark, sf, 4)


# ---------------------------------------------------------------- result files, written and read back

def _read_back(spark, path: str, schema: str) -> DataFrame:
    """The files' own header must name the columns in this order."""
    return spark.read.schema(schema).options(header="true", enforceSchema="false").csv(path)


def _group_means_4d(spark, sf):
    df, mm = _prep4(spark, sf)
    c = member_centroids(df, mm, PL.MAPPING_4D, label="event_type")
    return c.withColumn("dow", decode_day("dow_x", "dow_y"))


def q_csv_centroids_2d(spark, sf):
    df, mm = _prep2(spark, sf)
    path = scratch_path(spark, "csv-centroids-2d")
    write_centroids(member_centroids(df, mm, PL.MAPPING_2D, label="event_type"), path, ("x", "y"))
    return _read_back(spark, path, "x double, y double").select(_r("x").alias("x"), _r("y").alias("y"))


def q_csv_centroids_4d(spark, sf):
    path = scratch_path(spark, "csv-centroids-4d")
    write_centroids(_group_means_4d(spark, sf), path, ("x", "y", "dow"))
    back = _read_back(spark, path, "x double, y double, dow double")
    return back.select(*[_r(c).alias(c) for c in back.columns])


def q_csv_elbow(spark, sf):
    path = scratch_path(spark, "csv-elbow")
    write_elbow(PL.lloyd_elbow(_points(spark, sf), ks=CSV_ELBOW_KS, tol=ELBOW_TOL, max_iter=ELBOW_MAX_ITER, seed=LLOYD_SEED), path)
    return _read_back(spark, path, "NumOfCluster int, Cost double").select("NumOfCluster", _r("Cost", 4).alias("Cost"))


def q_csv_lloyd_centroids(spark, sf):
    path = scratch_path(spark, "csv-lloyd-centroids")
    named = _group_means_4d(spark, sf).selectExpr("cluster", "x AS X", "y AS Y", "dow AS Day")
    write_centroids(named, path, ("X", "Y", "Day"))
    back = _read_back(spark, path, "X double, Y double, Day double")
    return back.select(*[_r(c).alias(c) for c in back.columns])


def q_csv_points(spark, sf):
    p = _prep_lloyd(spark, sf)
    seeds = seed_centroids(p.df, p.features, LLOYD_K, LLOYD_SEED)
    lab = assign(p.df, p.features, seeds, "Cluster").withColumn("Day", decode_day("dow_x", "dow_y"))
    path = scratch_path(spark, "csv-points")
    write_points(lab, path)
    return _read_back(spark, path, "Cluster int, X double, Y double, Day double").select("Cluster", "X", "Y", _r("Day", 6).alias("Day"))


def q_csv_geocoded(spark, sf):
    path = scratch_path(spark, "csv-geocoded")
    write_geocoded(geocode(_labelled_centroids(spark, sf)), path)
    back = _read_back(spark, path, "LONGITUDE double, LATITUDE double, LABEL string")
    return back.select(_r("LONGITUDE", 7).alias("LONGITUDE"), _r("LATITUDE", 7).alias("LATITUDE"), "LABEL")


# ---------------------------------------------------------------- tiles and projection

def _clean_points(spark, sf):
    return complete_rows(_points(spark, sf), ["X", "Y"])


def q_tile_of_point(spark, sf):
    return tile_ops.with_tile(_clean_points(spark, sf)).select("id", "tile")


def q_tile_rollup_counts(spark, sf):
    return tile_ops.rollup_counts(tile_ops.with_tile(_clean_points(spark, sf)))


def _tile_names(spark, sf) -> DataFrame:
    """Names derived from the points: every roll-up level plus malformed
    variants (too short, too long, illegal letter, two-character L/R name,
    seven characters ending in R, a name and a line end)."""
    t = F.col("_t9")
    variants = F.concat(
        tile_rollup(t),
        F.array(F.substring(t, 1, 1), F.concat(t, F.lit("L")),
                F.concat(F.lit("O"), F.substring(t, 2, 6)),
                F.concat(F.substring(t, 1, 1), F.lit("L")),
                F.concat(F.substring(t, 1, 6), F.lit("R")),
            F.concat(t, F.lit("\n"))))
    pts = _clean_points(spark, sf).select(tile_of_xy("X", "Y").alias("_t9")).distinct()
    return pts.select(F.explode(variants).alias("tile")).distinct()


def q_tile_describe(spark, sf):
    d = tile_ops.describe(_tile_names(spark, sf), "tile", ("sw", *sorted(set(ANCHORS) - {"sw"})))
    return d.select("tile", "level", "width", "height", *[c for c in d.columns if c.endswith(("_x", "_y"))])


def q_tile_cover(spark, sf):
    return tile_ops.cover(_clean_points(spark, sf), "X", "Y", level=5)


def q_tile_cover_positions(spark, sf):
    """The covered tiles with their places in first-seen order."""
    return seen_positions(tile_ops.cover(_clean_points(spark, sf), "X", "Y", level=5))


GRIDS = (2391, 2392, 2393, 2394, 32634, 32635, 32636)


def q_project_grids(spark, sf):
    """National grid points in the old grid's zones and in UTM, and back."""
    pts, out = _clean_points(spark, sf).select("id", "X", "Y"), None
    for code in GRIDS:
        there = to_latlon(pts, "X", "Y", "n", "e", f"epsg:{code}")
        back = to_xy(there, "n", "e", "X2", "Y2", f"epsg:{code}")
        one = back.select("id", F.lit(code).alias("epsg"), _r("n", 3).alias("easting"), _r("e", 3).alias("northing"),
                          (F.greatest(F.abs(F.col("X2") - F.col("X")), F.abs(F.col("Y2") - F.col("Y"))) < 0.001).alias("back_within_mm"))
        out = one if out is None else out.unionByName(one)
    return out


def q_project_datums(spark, sf):
    """Geographic points of the old datum: in WGS 84, and their tiles."""
    pts = _lonlat_points(spark, sf)
    moved = transform(pts, "epsg:4123", "epsg:4326", "lat", "lon", ("lat2", "lon2"))
    tiles = tile_of_latlon(moved, "lat", "lon", src="epsg:4123")
    return tiles.select("id", _r("lat2", 7).alias("lat"), _r("lon2", 7).alias("lon"), "tile")


def q_project_to_lonlat(spark, sf):
    ll = to_latlon(_clean_points(spark, sf), "X", "Y")
    return ll.select("id", _r("lat", 7).alias("lat"), _r("lon", 7).alias("lon"))


def _lonlat_points(spark, sf):
    """Geographic points made from the event id, independent of the grid."""
    eid = F.col("event_id")
    return FX.table(spark, sf, "events").select(
        eid.alias("id"), (F.lit(60.0) + (eid * 7919) % 990000 / F.lit(100000.0)).alias("lat"),
        (F.lit(20.0) + (eid * 104729) % 1150000 / F.lit(100000.0)).alias("lon"))


def q_project_to_xy(spark, sf):
    xy = to_xy(_lonlat_points(spark, sf), "lat", "lon", "x", "y")
    return xy.select("id", _r("x", 3).alias("x"), _r("y", 3).alias("y"))


def q_tile_of_lonlat(spark, sf):
    return tile_of_latlon(_lonlat_points(spark, sf)).select("id", "tile")


def q_tile_of_lonlat_uniq(spark, sf):
    """Distinct level-4 tiles of geographic points, by first sight."""
    return tile_of_latlon(_lonlat_points(spark, sf), level=4, uniq=True)


def _labelled_centroids(spark, sf):
    df, mm = _prep2(spark, sf)
    cents = member_centroids(df, mm, {"X_scaled": "x", "Y_scaled": "y"}, label="event_type")
    return cents.select(_r("x", 3).alias("x"), _r("y", 3).alias("y"),
                        F.when(F.col("cluster") != "view", F.col("cluster")).alias("label"))


def q_geocode_centroids(spark, sf):
    g = geocode(_labelled_centroids(spark, sf))
    return g.select(_r("LONGITUDE", 7).alias("LONGITUDE"), _r("LATITUDE", 7).alias("LATITUDE"), "LABEL")


def q_preview(spark, sf):
    return preview(_clean_points(spark, sf).select("id", "X", "Y", "Vkpv"), 10, "id")


QUERIES: dict[str, Query] = {
    "points_clean": q_points_clean,
    "raw_line_parse": q_raw_line_parse,
    "raw_line_scan": q_raw_line_scan,
    "csv_roundtrip_scan": q_csv_roundtrip_scan,
    "coordinate_csv_scan": q_coordinate_csv_scan,
    "coordinate_rejects": q_coordinate_rejects,
    "dirty_reject_counts": q_dirty_reject_counts,
    "weekday_dim_join": q_weekday_dim_join,
    "weekday_cyclic_decode": q_weekday_cyclic_decode,
    "weekday_number_round_trip": q_weekday_number_round_trip,
    "extremes_2d": q_extremes_2d,
    "extremes_4d": q_extremes_4d,
    "minmax_scale": q_minmax_scale,
    "minmax_scale_lineitem": q_minmax_scale_lineitem,
    "minmax_unscale": q_minmax_unscale,
    "group_centroids_2d": q_group_centroids_2d,
    "group_centroids_4d": q_group_centroids_4d,
    "group_centroids_nd": q_group_centroids_nd,
    "cost_l2_sum_2d": q_cost_l2_sum_2d,
    "cost_l2_sum_4d": q_cost_l2_sum_4d,
    "cost_sse": q_cost_sse,
    "cost_sse_total": q_cost_sse_total,
    "sample_seeds": q_sample_seeds,
    "nearest_centroid": q_nearest_centroid,
    "nearest_centroid_indexed": q_nearest_centroid_indexed,
    "lloyd_indexed_steps": q_lloyd_indexed_steps,
    "lloyd_bounded": q_lloyd_bounded,
    "lloyd_step": q_lloyd_step,
    "lloyd_fixed_iters": q_lloyd_fixed_iters,
    "centroid_shift": q_centroid_shift,
    "lloyd_pipeline": q_lloyd_pipeline,
    "lloyd_labelled_points": q_lloyd_labelled_points,
    "lloyd_elbow": q_lloyd_elbow,
    "kmeans_2d": q_kmeans_2d,
    "kmeans_4d": q_kmeans_4d,
    "kmeans_reloaded": q_kmeans_reloaded,
    "csv_geocoded_file": q_csv_geocoded_file,
    "sample_seeds_many": q_sample_seeds_many,
    "kmeans_elbow_2d": q_kmeans_elbow_2d,
    "kmeans_elbow_4d": q_kmeans_elbow_4d,
    "csv_centroids_2d": q_csv_centroids_2d,
    "csv_centroids_4d": q_csv_centroids_4d,
    "csv_elbow": q_csv_elbow,
    "csv_lloyd_centroids": q_csv_lloyd_centroids,
    "csv_points": q_csv_points,
    "csv_geocoded": q_csv_geocoded,
    "tile_of_point": q_tile_of_point,
    "tile_rollup_counts": q_tile_rollup_counts,
    "tile_describe": q_tile_describe,
    "tile_cover": q_tile_cover,
    "infer_types": q_infer_types,
    "read_inferred": q_read_inferred,
    "described_tables": q_described_tables,
    "tile_cover_positions": q_tile_cover_positions,
    "project_grids": q_project_grids,
    "project_datums": q_project_datums,
    "project_to_lonlat": q_project_to_lonlat,
    "project_to_xy": q_project_to_xy,
    "tile_of_lonlat": q_tile_of_lonlat,
    "tile_of_lonlat_uniq": q_tile_of_lonlat_uniq,
    "geocode_centroids": q_geocode_centroids,
    "preview": q_preview,
}


# ---------------------------------------------------------------- SQL twins

def _lloyd_final_sql(select: str, models: list[int], tol: float, max_iter: int) -> str:
    cte = O.with_ctes(O.WEEKDAYS_CTE, O.POINTS_CTE, O.ENC_CTE, O.CLEAN4_CTE, O.LLOYD_PTS_CTE,
                      O.lloyd_recursive_cte(models, LLOYD_SEED, tol, max_iter), recursive=True)
    return cte + select


def _unscale_sql(col: str, lo: str, hi: str) -> str:
    return f"({col} * ({hi} - {lo}) + {lo})"


def oracle() -> dict[str, str]:
    W, PT, EN, C2, C4 = O.WEEKDAYS_CTE, O.POINTS_CTE, O.ENC_CTE, O.CLEAN2_CTE, O.CLEAN4_CTE
    base = O.with_ctes(W, PT, EN, C2, C4)
    s2 = O.with_ctes(W, PT, EN, C2, C4, O.SCALED2_CTE)
    s4 = O.with_ctes(W, PT, EN, C2, C4, O.SCALED4_CTE)
    sl = O.with_ctes(W, PT, EN, C2, C4, O.LLOYD_PTS_CTE)
    clean_full = "SELECT id, X, Y, Vkpv FROM points WHERE X IS NOT NULL AND NOT isnan(X) AND Y IS NOT NULL AND Vkpv IS NOT NULL AND length(trim(Vkpv)) > 0"
    li_cols = _LI_COLS
    li_b = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in li_cols)
    li_clean = "SELECT * FROM lineitem WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in li_cols)
    li_scaled = ", ".join(f"round({O.scaled(c, 'lo_' + c, 'hi_' + c)}, 12) AS {c}_scaled" for c in li_cols)
    li_back = ", ".join(
        f"round({_unscale_sql(O.scaled(c, 'lo_' + c, 'hi_' + c), 'lo_' + c, 'hi_' + c)}, 6) AS {c}_back" for c in li_cols)
    l2 = lambda feats: (
        "SELECT round(sum(sqrt(" + " + ".join(f"(s.{f} - m.avg_{f}) * (s.{f} - m.avg_{f})" for f in feats)
        + ")), 6) AS cost FROM {s} s LEFT JOIN (SELECT event_type, "
        + ", ".join(f"avg({f}) AS avg_{f}" for f in feats) + " FROM {s} GROUP BY event_type) m ON s.event_type IS NOT DISTINCT FROM m.event_type")
    f4 = list(PL.FEATURES_4D)
    means4 = ("SELECT " + ", ".join(
        _unscale_sql(f"avg({f})", f"any_value({lo})", f"any_value({hi})") + f" AS {n}"
        for f, lo, hi, n in zip(f4, ("lx", "ly", "la", "lb"), ("hx", "hy", "ha", "hb"), ("x", "y", "dx", "dy")))
        + " FROM s4, b4 GROUP BY event_type")
    sse4 = " + ".join(f"var_pop({f}) * count(*)" for f in f4)
    seed_order = f"md5(CAST(id AS VARCHAR) || ':{LLOYD_SEED}')"
    seeds_sql = (f"seeds AS (SELECT row_number() OVER (ORDER BY {seed_order}, id) - 1 AS idx, id, f1, f2, f3, f4 "
                 f"FROM pts ORDER BY {seed_order}, id LIMIT {LLOYD_K})")
    d2 = " + ".join(f"(p.f{i} - c.f{i}) * (p.f{i} - c.f{i})" for i in range(1, 5))
    asg_sql = (f"asg AS (SELECT p.id, p.f1, p.f2, p.f3, p.f4, arg_min(c.idx, {{'d': {d2}, 'i': c.idx}}) AS cluster "
               f"FROM pts p, seeds c GROUP BY p.id, p.f1, p.f2, p.f3, p.f4)")
    lloyd_cents = ("SELECT CAST(s.idx AS INTEGER) AS cluster, s.n, round(" + _unscale_sql("s.f1", "bl.lx", "bl.hx")
                   + ", 4) AS X, round(" + _unscale_sql("s.f2", "bl.ly", "bl.hy") + ", 4) AS Y, round("
                   + O.decode("s.f3", "s.f4") + ", 6) AS Day FROM state s, bl WHERE s.stop")
    labelled = (f"SELECT p.id, CAST(arg_min(c.idx, {{'d': {d2}, 'i': c.idx}}) AS INTEGER) AS Cluster, p.X, p.Y, "
                f"round({O.decode('p.dow_x', 'p.dow_y')}, 6) AS Day FROM pts p, "
                "(SELECT s.* FROM state s JOIN (SELECT model, max(pass) - 1 AS pass FROM state GROUP BY model) l "
                "ON s.model = l.model AND s.pass = l.pass) c GROUP BY p.id, p.X, p.Y, p.dow_x, p.dow_y")
    tile = O.tile_sql("X", "Y")
    names_arr = "[" + ", ".join(O.rollup_sql("t")) + ", substr(t, 1, 1), t || 'L', 'O' || substr(t, 2, 6), " \
        "substr(t, 1, 1) || 'L', substr(t, 1, 6) || 'R', t || chr(10)]"
    anchors = ", ".join(
        f"{at} AS {'anchor' if a == 'sw' else a}_{axis}" if a != "0" else f"{at} AS \"0_{axis}\""
        for a in O.GRID_ANCHORS for axis, at in zip("xy", O.anchor_sql("tile", a)))
    w, h = O.size_sql("tile")
    lat, lon = O.latlon_sql("X", "Y")
    gx, gy = O.xy_sql("lat", "lon")
    lonlat = ("WITH places AS (SELECT event_id AS id, 60.0::DOUBLE + (event_id * 7919) % 990000 / 100000.0::DOUBLE AS lat, "
              "20.0::DOUBLE + (event_id * 104729) % 1150000 / 100000.0::DOUBLE AS lon FROM events), "
              f"grid AS (SELECT id, {gx} AS X, {gy} AS Y FROM places) ")
    glat, glon = O.latlon_sql("x", "y")
    lvl = O.level_sql("tile")
    return {
        "points_clean": base + clean_full,
        "raw_line_parse": base + clean_full,
        "raw_line_scan": base + clean_full,
        "csv_roundtrip_scan": base + clean_full,
        "coordinate_csv_scan": base + "SELECT X AS x, Y AS y, CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS label FROM points WHERE X IS NOT NULL AND NOT isnan(X) AND Y IS NOT NULL",
        "coordinate_rejects": base + (
            "SELECT count(*) AS n_rows, count(*) FILTER (WHERE X IS NOT NULL AND NOT isnan(X) AND Y IS NOT NULL) AS n_clean, "
            # a line without X holds Y alone, in the place of X
            "count(*) FILTER (WHERE CASE WHEN X IS NULL THEN Y IS NULL ELSE isnan(X) END) AS missing_x, "
            "count(*) FILTER (WHERE X IS NULL OR Y IS NULL) AS missing_y FROM points"),
        "dirty_reject_counts": base + (
            "SELECT count(*) AS n_rows, "
            "count(*) FILTER (WHERE X IS NOT NULL AND NOT isnan(X) AND Y IS NOT NULL AND dow_x IS NOT NULL AND dow_y IS NOT NULL) AS n_clean, "
            "count(*) FILTER (WHERE X IS NULL OR isnan(X) OR Y IS NULL OR dow_x IS NULL OR dow_y IS NULL) AS n_rejected, "
            "count(*) FILTER (WHERE X IS NULL OR isnan(X)) AS missing_X, count(*) FILTER (WHERE Y IS NULL) AS missing_Y, "
            "count(*) FILTER (WHERE dow_x IS NULL) AS missing_dow_x, count(*) FILTER (WHERE dow_y IS NULL) AS missing_dow_y FROM enc"),
        "weekday_dim_join": base + "SELECT id, CASE WHEN NOT isnan(X) THEN X END AS X, Y, dow_x, dow_y FROM enc",
        "weekday_number_round_trip": base + (
            "SELECT id, CAST(isodow(ts) AS INTEGER) AS day, CAST(list_position([" + ", ".join(f"'{n}'" for n in O.WEEKDAY_NAMES)
            + f"], Vkpv) AS INTEGER) AS named, round({O.decode('w.dow_x', 'w.dow_y')}, 9) AS dow FROM points p JOIN events e ON e.event_id = p.id "
            "JOIN (SELECT row_number() OVER () AS day, dow_x, dow_y FROM weekdays) w ON w.day = isodow(ts)"),
        "weekday_cyclic_decode": base + (
            f"SELECT p.id, p.Vkpv AS name, round({O.decode('w.dow_x', 'w.dow_y')}, 9) AS dow "
            "FROM points p LEFT JOIN weekdays w ON p.Vkpv = w.Vkpv"),
        "extremes_2d": base + "SELECT min(X) AS min_X, max(X) AS max_X, min(Y) AS min_Y, max(Y) AS max_Y FROM clean2",
        "extremes_4d": base + ("SELECT min(X) AS min_X, max(X) AS max_X, min(Y) AS min_Y, max(Y) AS max_Y, "
                               "min(dow_x) AS min_dow_x, max(dow_x) AS max_dow_x, min(dow_y) AS min_dow_y, "
                               "max(dow_y) AS max_dow_y FROM clean4"),
        "minmax_scale": s4 + "SELECT id, " + ", ".join(f"round({f}, 12) AS {f}" for f in f4) + " FROM s4",
        "minmax_scale_lineitem": f"WITH c AS ({li_clean}), b AS (SELECT {li_b} FROM c) "
                                 f"SELECT l_orderkey, l_linenumber, {li_scaled} FROM c, b",
        "minmax_unscale": f"WITH c AS ({li_clean}), b AS (SELECT {li_b} FROM c) "
                          f"SELECT l_orderkey, l_linenumber, {li_back} FROM c, b",
        "group_centroids_2d": s2 + (
            "SELECT event_type AS cluster, count(*) AS n, round(" + _unscale_sql("avg(X_scaled)", "any_value(lx)", "any_value(hx)")
            + ", 6) AS x, round(" + _unscale_sql("avg(Y_scaled)", "any_value(ly)", "any_value(hy)")
            + ", 6) AS y FROM s2, b2 GROUP BY event_type"),
        "group_centroids_4d": s4 + (
            "SELECT cluster, n, round(x, 6) AS x, round(y, 6) AS y, round(dow_x, 6) AS dow_x, round(dow_y, 6) AS dow_y, "
            f"round({O.decode('dow_x', 'dow_y')}, 6) AS dow FROM (SELECT event_type AS cluster, count(*) AS n, "
            + _unscale_sql("avg(X_scaled)", "any_value(lx)", "any_value(hx)") + " AS x, "
            + _unscale_sql("avg(Y_scaled)", "any_value(ly)", "any_value(hy)") + " AS y, "
            + _unscale_sql("avg(dow_x_scaled)", "any_value(la)", "any_value(ha)") + " AS dow_x, "
            + _unscale_sql("avg(dow_y_scaled)", "any_value(lb)", "any_value(hb)") + " AS dow_y "
            "FROM s4, b4 GROUP BY event_type)"),
        "group_centroids_nd": (
            "SELECT label, CAST(pos AS INTEGER) AS pos, count(*) AS n, round(avg(CAST(embedding[pos + 1] AS DOUBLE)), 6) AS avg_e "
            "FROM (SELECT label, embedding, unnest(range(len(embedding))) AS pos FROM embeddings) GROUP BY label, pos"),
        "cost_l2_sum_2d": s2 + l2(list(PL.FEATURES_2D)).format(s="s2"),
        "cost_l2_sum_4d": s4 + l2(f4).format(s="s4"),
        "cost_sse": s4 + ("SELECT event_type, count(*) AS n, " + ", ".join(f"round(avg({f}), 8) AS {f}" for f in f4)
                          + f", round({sse4}, 6) AS sse FROM s4 GROUP BY event_type"),
        "cost_sse_total": s4 + f"SELECT round(sum(sse), 6) AS sse FROM (SELECT {sse4} AS sse FROM s4 GROUP BY event_type)",
        "sample_seeds": sl + ", " + seeds_sql + "\nSELECT CAST(idx AS INTEGER) AS idx, id, round(f1, 12) AS X_scaled, "
                        "round(f2, 12) AS Y_scaled, round(f3, 12) AS dow_x, round(f4, 12) AS dow_y FROM seeds",
        "sample_seeds_many": sl + ", " + seeds_sql.replace(f"LIMIT {LLOYD_K}", f"LIMIT {max(DEFAULT_KS)}") + "\nSELECT CAST(idx AS INTEGER) AS idx, id FROM seeds",
        "nearest_centroid": sl + ", " + seeds_sql + ", " + asg_sql + "\nSELECT id, CAST(cluster AS INTEGER) AS cluster FROM asg",
        "nearest_centroid_indexed": sl + ", " + O.line_places_cte(LLOYD_SEED, INDEXED_K) + ", " + asg_sql + "\nSELECT id, CAST(cluster AS INTEGER) AS cluster FROM asg",
        "lloyd_indexed_steps": _lloyd_final_sql(lloyd_cents, [INDEXED_LLOYD_K], 0.0, INDEXED_PASSES - 1),
        "lloyd_bounded": _lloyd_final_sql(lloyd_cents.replace("SELECT ", "SELECT true AS under_third, ", 1), [LLOYD_K], 0.0, BOUNDED_PASSES - 1),
        "lloyd_step": sl + ", " + seeds_sql + ", " + asg_sql + (
            "\nSELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS n, round(avg(f1), 8) AS X_scaled, "
            "round(avg(f2), 8) AS Y_scaled, round(avg(f3), 8) AS dow_x, round(avg(f4), 8) AS dow_y, round("
            + " + ".join(f"var_pop(f{i}) * count(*)" for i in range(1, 5)) + ", 6) AS sse FROM asg GROUP BY cluster"),
        "lloyd_fixed_iters": _lloyd_final_sql(lloyd_cents, [LLOYD_K], 0.0, FIXED_PASSES - 1),
        "centroid_shift": _lloyd_final_sql(
            "SELECT CAST(pass AS INTEGER) AS pass, round(any_value(shift), 6) AS shift, round(sum(sse), 6) AS sse "
            "FROM state WHERE pass > 0 GROUP BY pass", [LLOYD_K], 0.0, FIXED_PASSES - 1),
        "lloyd_pipeline": _lloyd_final_sql(lloyd_cents, [LLOYD_K], LLOYD_TOL, LLOYD_MAX_ITER),
        "lloyd_labelled_points": _lloyd_final_sql(labelled, [LLOYD_K], LLOYD_TOL, LLOYD_MAX_ITER),
        "lloyd_elbow": _lloyd_final_sql(
            "SELECT CAST(model AS INTEGER) AS NumOfCluster, round(sum(sse), 4) AS Cost, 'sse' AS metric "
            "FROM state WHERE stop GROUP BY model", list(DEFAULT_KS), ELBOW_TOL, ELBOW_MAX_ITER),
        "kmeans_2d": base + (
            "SELECT count(*) AS n_rows, count(*) AS n_assigned, CAST(0 AS BIGINT) AS n_off_nearest, true AS within_k, count(*) AS sum_n, "
            "CAST(round(sum(X), 0) AS BIGINT) AS sum_x, CAST(round(sum(Y), 0) AS BIGINT) AS sum_y FROM clean2"),
        "kmeans_4d": base + (
            "SELECT count(*) AS n_rows, count(*) AS n_assigned, CAST(0 AS BIGINT) AS n_off_nearest, true AS within_k, count(*) AS sum_n, "
            "CAST(round(sum(X), 0) AS BIGINT) AS sum_x, CAST(round(sum(Y), 0) AS BIGINT) AS sum_y, "
            "round(sum(dow_x), 4) AS sum_dow_x, round(sum(dow_y), 4) AS sum_dow_y FROM clean4"),
        "kmeans_reloaded": base + (
            "SELECT count(*) AS n_rows, count(*) AS n_assigned, CAST(0 AS BIGINT) AS n_differing, CAST(0 AS BIGINT) AS n_off_nearest, true AS within_k, "
            + ", ".join(f"round({end}({f}), 9) AS {name}_{f}" for f in ("X", "Y", "dow_x", "dow_y") for end, name in (("min", "lo"), ("max", "hi")))
            + " FROM clean4"),
        **{f"kmeans_elbow_{d}d": base + (
            "SELECT CAST(k AS INTEGER) AS NumOfCluster, 'sum_distance' AS metric, n AS n_rows, n AS n_assigned, "
            f"CAST(0 AS BIGINT) AS n_off_nearest, true AS within_k, true AS cost_ok FROM (SELECT count(*) AS n FROM clean{d}), "
            f"(SELECT unnest([{', '.join(map(str, DEFAULT_KS))}]) AS k)") for d in (2, 4)},
        "csv_centroids_2d": s2 + (
            "SELECT round(" + _unscale_sql("avg(X_scaled)", "any_value(lx)", "any_value(hx)") + ", 6) AS x, round("
            + _unscale_sql("avg(Y_scaled)", "any_value(ly)", "any_value(hy)") + ", 6) AS y FROM s2, b2 GROUP BY event_type"),
        "csv_centroids_4d": s4 + f"SELECT round(x, 6) AS x, round(y, 6) AS y, round({O.decode('dx', 'dy')}, 6) AS dow FROM ({means4})",
        "csv_lloyd_centroids": s4 + f"SELECT round(x, 6) AS X, round(y, 6) AS Y, round({O.decode('dx', 'dy')}, 6) AS Day FROM ({means4})",
        "csv_elbow": _lloyd_final_sql(
            "SELECT CAST(model AS INTEGER) AS NumOfCluster, round(sum(sse), 4) AS Cost FROM state WHERE stop GROUP BY model",
            list(CSV_ELBOW_KS), ELBOW_TOL, ELBOW_MAX_ITER),
        "csv_points": sl + ", " + seeds_sql + ", " + asg_sql + (
            f"\nSELECT CAST(a.cluster AS INTEGER) AS Cluster, p.X, p.Y, round({O.decode('p.dow_x', 'p.dow_y')}, 6) AS Day "
            "FROM asg a JOIN pts p ON a.id = p.id"),
        "tile_of_point": base + f"SELECT id, {tile} AS tile FROM clean2",
        "tile_rollup_counts": base + (
            f"SELECT CAST(l.level AS INTEGER) AS level, l.tile, count(*) AS n FROM (SELECT {tile} AS t FROM clean2) p, "
            f"LATERAL (SELECT unnest(range(10)) AS level, unnest([{', '.join(O.rollup_sql('p.t'))}]) AS tile) l "
            "WHERE p.t IS NOT NULL GROUP BY l.level, l.tile"),
        "tile_describe": base + (
            f"SELECT tile, {lvl} AS level, {w} AS width, {h} AS height, {anchors} FROM (SELECT DISTINCT unnest({names_arr}) AS tile "
            f"FROM (SELECT {tile} AS t FROM clean2) WHERE t IS NOT NULL)"),
        "tile_cover": base + (
            f"SELECT tile, min(id) AS first_id, count(*) AS n FROM (SELECT id, {O.rollup_sql(tile)[5]} AS tile "
            "FROM clean2) WHERE tile IS NOT NULL GROUP BY tile"),
        "infer_types": base + O.types_sql(),
        "read_inferred": base + (
            "SELECT count(*) AS n, CAST(sum(id) AS BIGINT) AS sum_id, sum(CASE WHEN isnan(X) THEN 0.0 ELSE X END) AS sum_x, CAST(sum(Y) AS BIGINT) AS sum_y, "
            "'int,double,int,string' AS kinds FROM points"),
        "described_tables": O.described_sql(),
        "tile_cover_positions": base + (
            f"SELECT tile, first_id, n, row_number() OVER (ORDER BY first_id, tile) - 1 AS position FROM (SELECT tile, min(id) AS first_id, count(*) AS n "
            f"FROM (SELECT id, {O.rollup_sql(tile)[5]} AS tile FROM clean2) WHERE tile IS NOT NULL GROUP BY tile)"),
        "project_grids": base + ", " + O.grids_sql(GRIDS),
        "project_datums": O.datums_sql(tile),
        "project_to_lonlat": base + f"SELECT id, round({lat}, 7) AS lat, round({lon}, 7) AS lon FROM clean2",
        "project_to_xy": lonlat + "SELECT id, round(X, 3) AS x, round(Y, 3) AS y FROM grid",
        "tile_of_lonlat": lonlat + f"SELECT id, {tile} AS tile FROM grid",
        "tile_of_lonlat_uniq": lonlat + (
            f"SELECT tile, min(id) AS first_id, count(*) AS n FROM (SELECT id, {O.rollup_sql(tile)[4]} AS tile FROM grid) "
            "WHERE tile IS NOT NULL GROUP BY tile"),
        **{name: s2 + (
            f"SELECT round({glon}, 7) AS LONGITUDE, round({glat}, 7) AS LATITUDE, "
            f"coalesce(label, printf('(%.7f,%.7f)', {glon}, {glat})) AS LABEL{more} FROM ("
            "SELECT round(" + _unscale_sql("avg(X_scaled)", "any_value(lx)", "any_value(hx)") + ", 3) AS x, round("
            + _unscale_sql("avg(Y_scaled)", "any_value(ly)", "any_value(hy)") + ", 3) AS y, "
            "CASE WHEN event_type <> 'view' THEN event_type END AS label FROM s2, b2 GROUP BY event_type)")
           for name, more in (("geocode_centroids", ""), ("csv_geocoded", ""), ("csv_geocoded_file", ", true AS named"))},
        "preview": base + "SELECT id, X, Y, Vkpv FROM points WHERE X IS NOT NULL AND NOT isnan(X) AND Y IS NOT NULL ORDER BY id LIMIT 10",
    }
