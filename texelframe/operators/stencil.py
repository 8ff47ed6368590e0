"""Normal maps from height: a central-difference stencil over four scales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from texelframe.operators import samples
from texelframe.operators.placement import TILE, Span, place_by_tile, virtual_positions
from texelframe.schema import RGB, plane_keys, with_size

REACH = 4
# Scale weights and grey weights of the two stock conversions.
COLOR_SCALES = (1 / 1.875, 0.5 / 1.875, 0.25 / 1.875, 0.125 / 1.875)
COLOR_GREY = (1 / 3, 1 / 3, 1 / 3, 0.0)
HEIGHT_SCALES = (2.0, 1.0, 1.0, 1.0)
HEIGHT_GREY = (2.0, 4.0, 1.0, 0.0)
HEIGHT_FACTOR = 0.2


def _height_rows(df: DataFrame, wrap: str) -> DataFrame:
    """One row per tile and line of its own, with the heights of that line and of REACH lines on either side.

    A sample is sent to each tile that reads it, once. There a line becomes an array by x, beginning REACH to the
    left of the tile, and the lines of a tile an array by y. Absent samples are nulls.
    """
    keys = [*plane_keys(df), "width", "height", "tile", "ty", "tx"]
    rows = with_size(df)
    rows = rows.select(*plane_keys(df), "width", "height", "y", "x", F.col("a").alias("_h"))
    rows = rows.withColumn("_jx", virtual_positions("x", "width", str(REACH), wrap))
    rows = rows.withColumn("_jy", virtual_positions("y", "height", str(REACH), wrap)).drop("x", "y")

    def span(j: str, size: str) -> Span:
        return f"greatest(0, {j} - {REACH})", f"least({size} - 1, {j} + {REACH})"

    def dense(entries: str, j: str, tile: str, size: str) -> str:
        """Array of the entries' values by place; a gap in them is a null."""
        low, high = f"{tile} * {TILE} - {REACH}", f"least({size} - 1, {tile} * {TILE} + {TILE - 1}) + {REACH}"
        by_place = f"transform(sequence({low}, {high}), k -> get(filter({entries}, e -> e.{j} = k).v, 0))"
        return f"CASE WHEN size({entries}) = {high} - ({low}) + 1 THEN {entries}.v ELSE {by_place} END"

    placed = place_by_tile(rows, span("_jy", "height"), span("_jx", "width"))
    lines = placed.groupBy(*keys, "_jy").agg(F.expr("array_sort(collect_list(struct(_jx, _h AS v)))").alias("_line"))
    lines = lines.withColumn("_line", F.expr(dense("_line", "_jx", "tx", "width")))
    tiles = lines.groupBy(*keys).agg(F.expr("array_sort(collect_list(struct(_jy, _line AS v)))").alias("_lines"))
    tiles = tiles.withColumn("_lines", F.expr(dense("_lines", "_jy", "ty", "height")))
    own = tiles.withColumn("y", F.expr(f"explode(sequence(ty * {TILE}, least(height - 1, ty * {TILE} + {TILE - 1})))"))
    near = {f"_l{k}": F.expr(f"get(_lines, y - ty * {TILE} + {k})") for k in range(2 * REACH + 1)}
    return own.withColumns(near).drop("_lines")


def to_normal_map(df: DataFrame, w1: float, w2: float, w3: float, w4: float, wrap: str = "clamp") -> DataFrame:
    """Signed unit normals in r,g,b from the height in alpha, which stays.

    Slope along an axis: sum over k = 1..4 of w_k * (h(+k) - h(-k)) / (2k), where absent samples count as 0. Positions without a
    sample have no normal.
    """
    at = f"x - tx * {TILE}"
    lines = _height_rows(df, wrap).withColumn("x", F.expr(f"explode(sequence(tx * {TILE}, least(width - 1, tx * {TILE} + {TILE - 1})))"))

    def height(line: int, ahead: int) -> str:
        return f"coalesce(get(_l{line}, {at} + {ahead}), 0D)"

    across, down = [], []
    for k, w in enumerate((w1, w2, w3, w4), start=1):
        share = w / (2 * k)
        across.append(f"({height(REACH, REACH + k)} - {height(REACH, REACH - k)}) * {share!r}D")
        down.append(f"({height(REACH + k, REACH)} - {height(REACH - k, REACH)}) * {share!r}D")
    slopes = lines.select(
        *plane_keys(df), "width", "height", "y", "x", F.expr(f"get(_l{REACH}, {at} + {REACH})").alias("a"),
        F.expr(" + ".join(across)).alias("_sx"), F.expr(" + ".join(down)).alias("_sy"),
    ).filter("a IS NOT NULL")
    length = F.sqrt(F.col("_sx") * F.col("_sx") + F.col("_sy") * F.col("_sy") + 1.0)
    normal = {"r": -F.col("_sx") / length, "g": -F.col("_sy") / length, "b": F.lit(1.0) / length}
    return slopes.withColumns(normal).select(*plane_keys(df), "width", "height", "y", "x", *RGB, "a")


def color_to_normal(df: DataFrame, wrap: str = "clamp") -> DataFrame:
    """Normal map from the plain mean of the colour channels."""
    return to_normal_map(samples.to_grey(df, *COLOR_GREY), *COLOR_SCALES, wrap=wrap)


def height_to_packed_normal(df: DataFrame, wrap: str = "clamp") -> DataFrame:
    """Packed normal map from a scaled-down, weighted height."""
    grey = samples.copy_channel(samples.to_grey(df, *HEIGHT_GREY), "r", "a")
    height = samples.scale_bias(grey, "a", HEIGHT_FACTOR)
    return samples.pack_normals(to_normal_map(height, *HEIGHT_SCALES, wrap=wrap))
