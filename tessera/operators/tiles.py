"""Map-sheet tile operators over point tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.dedupe import first_seen
from tessera.functions.tiles import inside_grid, tile_anchor, tile_level, tile_of_xy, tile_rollup, tile_size


def with_tile(df: DataFrame, x: str = "X", y: str = "Y", out: str = "tile", level: int = 9) -> DataFrame:
    """Adds the tile name of each point at ``level`` (null outside the grid).

    The level-9 name is computed once into its own column; shorter names are
    cut from that column (Catalyst keeps the projection split instead of
    copying the whole expression into every prefix).
    """
    if level not in range(10):
        raise ValueError(f"level must be 0..9, got {level}")
    if level == 9:
        return df.withColumn(out, tile_of_xy(x, y))
    full = df.withColumn("_tile9", tile_of_xy(x, y))
    return full.withColumn(out, F.element_at(tile_rollup("_tile9"), level + 1)).drop("_tile9")


def rollup_counts(df: DataFrame, tile_col: str = "tile") -> DataFrame:
    """Points per tile at every level 0..9: counted per level-9 name first (at
    most 133,120 names), then each name's count is added to its 10 ancestors."""
    own = df.groupBy(F.col(tile_col).alias("_name")).agg(F.count(F.lit(1)).alias("_n"))
    exploded = own.select("_n", F.posexplode(tile_rollup("_name")).alias("level", "tile"))
    return exploded.groupBy("level", "tile").agg(F.sum("_n").alias("n"))


def cover(df: DataFrame, x: str = "X", y: str = "Y", level: int = 9, order_col: str = "id",
          out: str = "tile") -> DataFrame:
    """Distinct tiles at ``level`` covering the points, with their first-seen
    position (``first_id``; order by it for first-seen order) and point
    count. Points outside the grid are left out by a bounding-box filter
    before the name is built."""
    inside = df.select(order_col, x, y).filter(inside_grid(x, y))
    named = with_tile(inside, x, y, out, level)
    return first_seen(named, out, order_col).withColumnRenamed(f"first_{order_col}", "first_id")


def describe(df: DataFrame, tile_col: str = "tile", anchors=("sw",)) -> DataFrame:
    """Level, size and anchor points of each tile name (nulls / -1 if
    malformed). The first anchor goes to ``anchor_x/anchor_y``, others to
    ``<anchor>_x/<anchor>_y``."""
    leveled = df.withColumn("level", tile_level(tile_col))
    w, h = tile_size(tile_col, "level")
    cols = {"width": w, "height": h}
    for i, a in enumerate(anchors):
        ax, ay = tile_anchor(tile_col, a, "level")
        prefix = "anchor" if i == 0 else a
        cols[f"{prefix}_x"], cols[f"{prefix}_y"] = ax, ay
    return leveled.withColumns(cols)
