"""Per-sample operators: projections over the channel columns.

They never shuffle, so chains of them fuse into one generated stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from texelframe.functions import color, quantize
from texelframe.schema import CHANNELS, RGB, channels


def map_samples(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    """Replace channels by arbitrary expressions over the sample's columns."""
    return df.withColumns(changes)


def map_channels(df: DataFrame, fn: Callable[[Column], Column], names=RGB) -> DataFrame:
    return df.withColumns({c: fn(F.col(c)) for c in names if c in df.columns})


def scale_bias(df: DataFrame, channel: str, scale, bias=0.0) -> DataFrame:
    return df.withColumn(channel, color.scale_bias(F.col(channel), scale, bias))


def clamp(df: DataFrame, channel: str, low: float = 0.0, high: float = 1.0) -> DataFrame:
    return df.withColumn(channel, color.clamp(F.col(channel), low, high))


def tone_map_linear(df: DataFrame) -> DataFrame:
    """Bring rgb into range by one common factor, which keeps the hue."""
    return map_channels(df, lambda c: color.tone_map(c, *map(F.col, RGB)))


def to_gamma(df: DataFrame, gamma: float = 2.2) -> DataFrame:
    return map_channels(df, lambda c: color.gamma_encode(c, gamma))


def to_linear(df: DataFrame, gamma: float = 2.2) -> DataFrame:
    return map_channels(df, lambda c: color.gamma_decode(c, gamma))


def to_srgb(df: DataFrame) -> DataFrame:
    return map_channels(df, color.srgb_encode)


def to_linear_from_srgb(df: DataFrame) -> DataFrame:
    return map_channels(df, color.srgb_decode)


def to_srgb_unclamped(df: DataFrame) -> DataFrame:
    return map_channels(df, color.srgb_encode_unclamped)


def to_linear_from_srgb_unclamped(df: DataFrame) -> DataFrame:
    return map_channels(df, color.srgb_decode_unclamped)


def premultiply(df: DataFrame) -> DataFrame:
    return map_channels(df, lambda c: color.premultiply(c, F.col("a")))


def demultiply(df: DataFrame, epsilon: float = 1e-12) -> DataFrame:
    return map_channels(df, lambda c: color.demultiply(c, F.col("a"), epsilon))


def to_rgbm(df: DataFrame, value_range: float = 1.0, threshold: float = color.RGBM_THRESHOLD) -> DataFrame:
    """Store HDR colour as colour times a multiplier kept in alpha."""
    rgb = [F.col(c) for c in RGB]
    encoded = {c: color.rgbm_encode(F.col(c), *rgb, threshold, value_range) for c in RGB}
    return df.withColumns({**encoded, "a": color.rgbm_alpha(*rgb, threshold, value_range)})


def from_rgbm(df: DataFrame, value_range: float = 1.0, threshold: float = color.RGBM_THRESHOLD) -> DataFrame:
    decoded = {c: color.rgbm_decode(F.col(c), F.col("a"), threshold, value_range) for c in RGB}
    return df.withColumns({**decoded, "a": F.lit(1.0)})


def to_grey(df: DataFrame, wr: float = 1.0, wg: float = 1.0, wb: float = 1.0, wa: float = 0.0) -> DataFrame:
    """Weighted mean of the channels, written to all four."""
    grey = color.grey(*map(F.col, CHANNELS), wr, wg, wb, wa)
    return df.withColumns({c: grey for c in CHANNELS})


def copy_channel(df: DataFrame, source: str, target: str) -> DataFrame:
    return df.withColumn(target, F.col(source))


def abs_channel(df: DataFrame, channel: str) -> DataFrame:
    return df.withColumn(channel, F.abs(F.col(channel)))


def normalize_normals(df: DataFrame) -> DataFrame:
    """Rescale the packed normals to unit length; a zero vector points up."""
    up = {"r": 0.5, "g": 0.5, "b": 1.0}
    return df.withColumns({c: color.normalized(F.col(c), *map(F.col, RGB), up[c]) for c in RGB})


def pack_normals(df: DataFrame, scale: float = 0.5, bias: float = 0.5) -> DataFrame:
    return map_channels(df, lambda c: color.scale_bias(c, scale, bias))


def to_slope_space(df: DataFrame) -> DataFrame:
    """Slopes of the normal, centred at 0.5. Samples with blue 0 stay as they are."""
    return map_channels(df, lambda c: color.slope(c, F.col("b")), ("r", "g"))


def quantize_unorm(df: DataFrame, bits: int = 8) -> DataFrame:
    return map_channels(df, lambda c: quantize.unorm(c, bits), CHANNELS)


def quantize_snorm(df: DataFrame, bits: int = 8) -> DataFrame:
    return map_channels(df, lambda c: quantize.snorm(c, bits), CHANNELS)


def binary_alpha(df: DataFrame, threshold: int = 127) -> DataFrame:
    return df.withColumn("a", quantize.above_threshold(F.col("a"), threshold))


def dither_alpha(df: DataFrame, bits: int = 8) -> DataFrame:
    return df.withColumn("a", quantize.ordered_dither(F.col("a"), F.col("x"), F.col("y"), bits))


def luminance(df: DataFrame) -> DataFrame:
    """Keep the red channel only."""
    return df.drop(*[c for c in channels(df) if c != "r"])


def resolve_alpha_mode(df: DataFrame, explicit: Column | None = None) -> DataFrame:
    """Alpha mode a conversion works with.

    An explicit choice (TRUE or FALSE, NULL for none) wins over the file's mode;
    BC6 formats and plain RGBM output carry none at all.
    """
    chosen = F.col("alpha_mode")
    if explicit is not None:
        named = F.when(explicit, "transparency").when(~explicit, "none")
        chosen = F.coalesce(named, chosen)
    opaque = F.col("format").isin("bc6", "bc6s", "rgbm")
    return df.withColumn("alpha_mode", F.when(opaque, "none").otherwise(chosen))


def planes(df: DataFrame, face: int | None = 0, mip: int | None = 0) -> DataFrame:
    """Samples of one face and level; None keeps the whole axis."""
    for key, wanted in (("face", face), ("mip", mip)):
        if wanted is not None:
            df = df.filter(F.col(key) == wanted)
    return df


def limit_levels(df: DataFrame, levels: int) -> DataFrame:
    return df.filter(F.col("mip") < levels)
