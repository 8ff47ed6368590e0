"""Tiles of fixed size: statistics and block range quantisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from texelframe.schema import CHANNELS, channels, image_keys, int_div, plane_keys


def with_tile(df: DataFrame, tile_w: int = 4, tile_h: int = 4) -> DataFrame:
    return df.withColumns({"by": int_div(F.col("y"), tile_h), "bx": int_div(F.col("x"), tile_w)})


def tile_stats(df: DataFrame, tile_w: int = 4, tile_h: int = 4) -> DataFrame:
    """Minimum, maximum and mean of each channel per tile; edge tiles are partial."""
    aggregates: list[Column] = [F.count(F.lit(1)).alias("n_samples")]
    for c in channels(df):
        aggregates += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"), F.avg(c).alias(f"avg_{c}")]
    return with_tile(df, tile_w, tile_h).groupBy(*plane_keys(df), "by", "bx").agg(*aggregates)


def block_quantize(df: DataFrame, names: tuple[str, ...] = ("r",), levels: int = 8, block: int = 4) -> DataFrame:
    """Replace channels by the nearest of ``levels`` steps of their block's range.

    Adds ``<c>_index`` (the step) and ``<c>_q`` (the value). The window groups are
    single blocks, so at most block * block samples each.
    """
    tile = Window.partitionBy(*plane_keys(df), "by", "bx")
    steps = levels - 1
    out = with_tile(df, block, block)
    out = out.withColumns(
        {f"_{name}_{c}": f(c).over(tile) for c in names for name, f in (("lo", F.min), ("hi", F.max))}
    )
    for c in names:
        low, span = F.col(f"_lo_{c}"), F.col(f"_hi_{c}") - F.col(f"_lo_{c}")
        index = F.floor((F.col(c) - low) / F.nullif(span, F.lit(0.0)) * steps + 0.5)
        out = out.withColumn(f"{c}_index", F.coalesce(index.cast("int"), F.lit(0)))
        out = out.withColumn(f"{c}_q", low + F.col(f"{c}_index") * span / steps)
    return out.drop("by", "bx", *[f"_{name}_{c}" for c in names for name in ("lo", "hi")])


def block_quantize_error(df: DataFrame, names: tuple[str, ...] = ("r",), levels: int = 8, block: int = 4) -> DataFrame:
    """RMSE per image and channel caused by block range quantisation."""
    quantized = block_quantize(df, names, levels, block)
    errors = [
        F.sqrt(F.avg((F.col(c) - F.col(f"{c}_q")) * (F.col(c) - F.col(f"{c}_q")))).alias(f"rmse_{c}") for c in names
    ]
    return quantized.groupBy(*image_keys(df)).agg(*errors)
