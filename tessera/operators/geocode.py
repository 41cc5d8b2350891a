"""Coordinate projection operators and the centroid geocoding job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.crs import transform
from tessera.functions.projection import latlon_to_xy, xy_to_latlon
from tessera.operators.tiles import cover, with_tile


GRID, GEOGRAPHIC = "epsg:3067", "epsg:4326"  # ETRS-TM35FIN, WGS 84


def to_latlon(df: DataFrame, x: str = "x", y: str = "y", lat: str = "lat", lon: str = "lon", dst: str = GEOGRAPHIC) -> DataFrame:
    """Adds latitude and longitude of national grid points. With another
    ``dst`` (see :mod:`tessera.functions.crs`) they are that system's
    coordinates: latitude and longitude, or easting and northing of a grid."""
    if dst != GEOGRAPHIC:
        return transform(df, GRID, dst, x, y, (lat, lon))
    la, lo = xy_to_latlon(x, y)
    return df.withColumns({lat: la, lon: lo})


def to_xy(df: DataFrame, lat: str = "lat", lon: str = "lon", x: str = "x", y: str = "y", src: str = GEOGRAPHIC) -> DataFrame:
    """Adds national grid coordinates of points given in ``src``."""
    if src != GEOGRAPHIC:
        return transform(df, src, GRID, lat, lon, (x, y))
    xx, yy = latlon_to_xy(lat, lon)
    return df.withColumns({x: xx, y: yy})


def tile_of_latlon(df: DataFrame, lat: str = "lat", lon: str = "lon", out: str = "tile", level: int = 9,
                   uniq: bool = False, order_col: str = "id", src: str = GEOGRAPHIC) -> DataFrame:
    """Adds the tile name at ``level`` of points given in ``src``; with ``uniq`` the distinct tiles with
    their first-seen ``order_col`` and count. The projection is evaluated once
    into columns of its own, which the tile digits then read."""
    placed = to_xy(df, lat, lon, "_x", "_y", src)
    if uniq:
        return cover(placed, "_x", "_y", level, order_col, out)
    return with_tile(placed, "_x", "_y", out, level).drop("_x", "_y")


def geocode(df: DataFrame, x: str = "x", y: str = "y", label: str | None = "label") -> DataFrame:
    """(x, y[, label]) grid points -> LONGITUDE, LATITUDE, LABEL. A missing
    label becomes "(lon,lat)" with 7 decimals."""
    la, lo = xy_to_latlon(x, y)
    out = df.select(lo.alias("LONGITUDE"), la.alias("LATITUDE"),
                    (F.col(label) if label and label in df.columns else F.lit(None).cast("string")).alias("_label"))
    default = F.format_string("(%.7f,%.7f)", F.col("LONGITUDE"), F.col("LATITUDE"))
    return out.select("LONGITUDE", "LATITUDE", F.coalesce(F.col("_label"), default).alias("LABEL"))
