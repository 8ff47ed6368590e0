"""Mip pyramids.

Two ways to the same levels. Box, minimum and maximum over power-of-two images
nest exactly, so every level comes from the first one inside its tile. Everything
else, wide kernels, odd sizes and levels renormalised on the way, is built level
by level; each level is written to reliable storage once and the next starts from
there, so the total work stays a geometric series and a lost executor costs one
level at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from texelframe.functions.sizes import UNLIMITED_MIPS, mip_count, mip_size
from texelframe.operators import samples
from texelframe.operators.placement import TILE, colocate_tiles
from texelframe.operators.resample import next_mip
from texelframe.schema import (
    carried, channels, has_size, image_keys, image_sizes, image_stats, int_div, join_image_stats, plane_keys, with_size,
)
from texelframe.session import cut_lineage

NESTING = {"box": F.avg, "min": F.min, "max": F.max}
# Levels a tile of level-1 samples holds completely: level 1 itself down to one sample.
TILE_LEVELS = TILE.bit_length()

Transform = Callable[[DataFrame], DataFrame]


def _is_power_of_two(size) -> Column:
    return size.bitwiseAND(size - 1) == 0


def _nests() -> Column:
    return _is_power_of_two(F.col("width")) & _is_power_of_two(F.col("height"))


def _nested_levels(base: DataFrame, name: str, deepest: int) -> DataFrame:
    """All levels below ``base`` for power-of-two images.

    Level 1 is an ordinary aggregate with map-side combine. Its quarter of the
    samples is placed by tile, and the levels a tile holds need no further
    exchange. Only one sample per tile goes on to deeper levels. Means are those of the
    chained way, also where samples are missing.
    """
    combine = NESTING[name]
    names = channels(base)
    keys = [*plane_keys(base), "width", "height", "n_mips", *carried(base)]

    def fold(rows: DataFrame, *extra: str) -> DataFrame:
        return rows.groupBy(*keys, *extra, "y", "x").agg(*[combine(c).alias(c) for c in names])

    halved = base.filter(F.col("mip") + 1 < F.col("n_mips")).withColumns(
        {"y": int_div(F.col("y"), 2), "x": int_div(F.col("x"), 2)}
    )
    placed = colocate_tiles(
        fold(halved).withColumns({"ty": int_div(F.col("y"), TILE), "tx": int_div(F.col("x"), TILE)})
    )

    # Each level from the one above it: where samples are missing, the mean of a level is
    # not that of level 1. All stay in their tile, so none needs an exchange.
    level = placed.withColumn("_level", F.lit(1))
    levels = level.select(*keys, "_level", "y", "x", *names)
    for step in range(2, min(TILE_LEVELS, deepest) + 1):
        halves = {c: int_div(F.col(c), 2) for c in ("y", "x")} | {"_level": F.lit(step)}
        level = fold(level.filter(F.col("n_mips") - 1 - F.col("mip") >= step).withColumns(halves), "tile", "_level")
        levels = levels.unionByName(level.select(*keys, "_level", "y", "x", *names))
    if deepest > TILE_LEVELS:
        # one sample of each tile is left: a few rows, level by level
        for step in range(TILE_LEVELS + 1, deepest + 1):
            halves = {c: int_div(F.col(c), 2) for c in ("y", "x")} | {"_level": F.lit(step)}
            level = fold(level.filter(F.col("n_mips") - 1 - F.col("mip") >= step).withColumns(halves), "_level")
            levels = levels.unionByName(level.select(*keys, "_level", "y", "x", *names))
    return levels.withColumns(
        {
            "mip": F.col("mip") + F.col("_level"),
            "width": mip_size(F.col("width"), F.col("_level")),
            "height": mip_size(F.col("height"), F.col("_level")),
        }
    ).drop("_level")


def _chained_levels(base: DataFrame, name: str, deepest: int, wrap: str, each_level: Transform | None) -> DataFrame | None:
    """Levels below ``base``, one after another."""
    current, levels = base, None
    for step in range(1, deepest + 1):
        current = next_mip(current.filter(F.col("mip") + 1 < F.col("n_mips")), name, wrap)
        if each_level is not None:
            current = each_level(current)
        if step < deepest:
            current = cut_lineage(current)
        levels = current if levels is None else levels.unionByName(current)
    return levels


def levels_below(
    base: DataFrame, sizes: DataFrame, name: str = "box", wrap: str = "clamp", each_level: Transform | None = None
) -> DataFrame | None:
    """Every level under the base rows, which carry width, height, mip and n_mips.

    ``sizes`` holds those four columns too and may be any smaller table with the
    same value combinations. A one-row aggregate over it tells how deep to go and
    whether some images need the chained way; None means there is nothing to build.
    """
    nestable = name in NESTING and each_level is None
    below = F.col("n_mips") - 1 - F.col("mip")
    chained = ~_nests() if nestable else F.lit(True)
    probe = sizes.agg(F.max(below).alias("deepest"), F.max(F.when(chained, below)).alias("chained")).first()
    parts = []
    if nestable and (probe["deepest"] or 0) > 0:
        parts.append(_nested_levels(base.filter(_nests()), name, probe["deepest"]))
    if (probe["chained"] or 0) > 0:
        rest = base.filter(~_nests()) if nestable else base
        parts.append(_chained_levels(rest, name, probe["chained"], wrap, each_level))
    levels = None
    for part in parts:
        levels = part if levels is None else levels.unionByName(part)
    return levels


def _pyramid(
    df: DataFrame,
    name: str,
    wrap: str,
    to_state: Transform | None,
    from_state: Transform | None,
    each_level: Transform | None = None,
    max_mips: int = UNLIMITED_MIPS,
    min_size: int = 1,
) -> DataFrame:
    count = mip_count(F.col("width"), F.col("height"), max_mips, min_size).alias("n_mips")
    df = df.filter(F.col("mip") == 0) if "mip" in df.columns else df.withColumn("mip", F.lit(0))
    if has_size(df):
        sized, sizes = df, df
    else:
        # worked out once, then read by the probe and by every use of the base
        sizes = cut_lineage(image_sizes(df))
        sized = join_image_stats(df, sizes)
    base = sized.select(*plane_keys(df), "width", "height", count, *carried(df), "y", "x", *channels(df))
    start = to_state(base) if to_state else base
    levels = levels_below(start, sizes.select("width", "height", "mip", count), name, wrap, each_level)
    if levels is None:
        return base.drop("n_mips")
    if from_state:
        levels = from_state(levels)
    return base.unionByName(levels).drop("n_mips")


def pyramid(
    df: DataFrame, name: str = "box", gamma: bool = True, wrap: str = "clamp",
    max_mips: int = UNLIMITED_MIPS, min_size: int = 1,
) -> DataFrame:
    """Colour pyramid: levels are filtered in linear light and stored as sRGB.

    Levels other than 0 in the input are ignored (see pyramid_from_source). The base level is passed through; its way to linear and back is the identity.
    """
    to_state = samples.to_linear_from_srgb_unclamped if gamma else None
    from_state = samples.to_srgb_unclamped if gamma else None
    return _pyramid(df, name, wrap, to_state, from_state, max_mips=max_mips, min_size=min_size)


def pyramid_alpha(df: DataFrame, max_mips: int = UNLIMITED_MIPS, min_size: int = 1) -> DataFrame:
    """Pyramid of images with transparency.

    Levels are averaged in linear light with colour premultiplied by alpha, then
    brought back. The chain itself stays premultiplied and linear, since undoing
    and redoing the conversions between levels changes nothing.
    """
    return _pyramid(
        df, "box", "clamp",
        lambda d: samples.premultiply(samples.to_linear_from_srgb(d)),
        lambda d: samples.to_srgb(samples.demultiply(d)),
        max_mips=max_mips, min_size=min_size,
    )


def pyramid_normal(
    df: DataFrame, name: str = "box", wrap: str = "clamp", renormalize: bool = True,
    max_mips: int = UNLIMITED_MIPS, min_size: int = 1,
) -> DataFrame:
    """Normal-map pyramid; each level is renormalised before the next is made."""
    each = samples.normalize_normals if renormalize else None
    return _pyramid(df, name, wrap, None, None, each, max_mips, min_size)


def pyramid_slope(df: DataFrame, max_mips: int = UNLIMITED_MIPS, min_size: int = 1) -> DataFrame:
    """Slope-space pyramid: converted once, then Kaiser-filtered as it is."""
    return _pyramid(samples.to_slope_space(df), "kaiser", "clamp", None, None, None, max_mips, min_size)


def faces_without_base(df: DataFrame) -> DataFrame:
    """Faces that have levels, but not level 0: no pyramid can be made of them."""
    faces = [k for k in image_keys(df) if k != "mip"]
    return df.groupBy(*faces).agg(F.min("mip").alias("first_mip")).filter("first_mip > 0").withColumn("code", F.lit("no_base"))


def pyramid_from_source(
    df: DataFrame, name: str = "box", gamma: bool = True, wrap: str = "clamp",
    max_mips: int = UNLIMITED_MIPS, min_size: int = 1, normal: bool = False, renormalize: bool = True,
) -> DataFrame:
    """Complete partly stored pyramids.

    Stored levels are kept up to the first one a face lacks; from there on every
    level is generated, whatever else is stored. Rows carry the width and height
    of their own level. Normal maps are filtered as they are, and each generated level is
    renormalised. Faces without level 0 have no rows (see faces_without_base).
    """
    gamma = gamma and not normal
    each = samples.normalize_normals if normal and renormalize else None
    df = with_size(df)
    faces = [k for k in image_keys(df) if k != "mip"]
    at_base = F.col("mip") == 0
    mips = F.collect_set("mip")
    first_gap = F.array_min(F.array_except(F.sequence(F.lit(0), F.lit(UNLIMITED_MIPS)), mips))
    per_face = image_stats(
        df,
        first_gap.alias("_gap"),
        F.max(F.when(at_base, F.col("width"))).alias("_w0"),
        F.max(F.when(at_base, F.col("height"))).alias("_h0"),
        keys=faces,
    )
    # a row per face, read by the probe and twice by the joins
    per_face = cut_lineage(
        per_face.withColumn("n_mips", mip_count(F.col("_w0"), F.col("_h0"), max_mips, min_size))
    )
    last_mip = F.col("_gap") - 1
    sizes = per_face.select(
        mip_size(F.col("_w0"), last_mip).alias("width"), mip_size(F.col("_h0"), last_mip).alias("height"),
        last_mip.alias("mip"), "n_mips",
    )
    stored = join_image_stats(df, per_face, faces)
    columns = [*plane_keys(df), "width", "height", "n_mips", *carried(df), "y", "x", *channels(df)]
    kept = stored.filter((F.col("mip") < F.col("_gap")) & (F.col("mip") < F.col("n_mips"))).select(*columns)
    last = stored.filter(F.col("mip") == last_mip).select(*columns)
    start = samples.to_linear_from_srgb_unclamped(last) if gamma else last
    levels = levels_below(start, sizes, name, wrap, each)
    if levels is None:
        return kept.drop("n_mips")
    if gamma:
        levels = samples.to_srgb_unclamped(levels)
    return kept.unionByName(levels).drop("n_mips")
