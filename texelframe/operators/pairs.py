"""Pairing of two images and channel exchange between them.

A pair row holds the reference channels r,g,b,a and the other image's channels
r2,g2,b2,a2 of the same sample.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from texelframe.schema import CHANNELS, sample_keys


def second(channel: str) -> str:
    return channel + "2"


def pair(reference: DataFrame, other: DataFrame, how: str = "inner") -> DataFrame:
    """Join two images sample by sample.

    By default samples without a partner drop out; ``how`` may keep those of either
    side (see compare_images). All sample keys are join keys, so an image of any
    shape spreads over as many tasks as it has samples, and the planner may
    broadcast a small side or split a skewed one.
    """
    keys = sample_keys(reference)
    renamed = other.select(*keys, *[F.col(c).alias(second(c)) for c in other.columns if c in CHANNELS or c.startswith("_")])
    return reference.join(renamed, keys, how)


def copy_channel_from(df: DataFrame, other: DataFrame, source: str, target: str) -> DataFrame:
    """Replace a channel by one of another image; where that has no sample, the channel stays."""
    paired = pair(df, other.select(*sample_keys(df), source), "left")
    return paired.withColumn(target, F.coalesce(second(source), target)).drop(second(source))


def add_channel(df: DataFrame, other: DataFrame, source: str, target: str, scale: float = 1.0) -> DataFrame:
    """Add a channel of another image; where that has no sample, nothing is added."""
    paired = pair(df, other.select(*sample_keys(df), source), "left")
    added = F.coalesce(F.col(target) + F.col(second(source)) * scale, F.col(target))
    return paired.withColumn(target, added).drop(second(source))


def diff_image(pairs: DataFrame) -> DataFrame:
    """Absolute difference of all four channels."""
    keys = sample_keys(pairs)
    return pairs.select(*keys, *[F.abs(F.col(c) - F.col(second(c))).alias(c) for c in CHANNELS])


def undo_bc3n(pairs: DataFrame) -> DataFrame:
    """Undo the (1, g, 0, r) layout on the second image of a pair.

    Red comes back from alpha; blue and alpha are taken from the reference.
    """
    return pairs.withColumns({"r2": F.col("a2"), "b2": F.col("b"), "a2": F.col("a")})


def pair_errors(reference: DataFrame, other: DataFrame) -> DataFrame:
    """Texture pairs whose width or height differ. Depth is not compared."""
    sizes = other.select("texture_id", F.col("width").alias("width2"), F.col("height").alias("height2"))
    joined = reference.select("texture_id", "width", "height").join(sizes, "texture_id")
    code = F.when(F.col("width") != F.col("width2"), "width").when(F.col("height") != F.col("height2"), "height")
    return joined.withColumn("code", code).filter(F.col("code").isNotNull())
