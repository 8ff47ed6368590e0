"""Ranges, difference metrics and histograms per image.

Every metric is a plain aggregate over pair rows, so any number of them share
one hash aggregate with map-side partial sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from texelframe.functions import color
from texelframe.operators.pairs import second
from texelframe.schema import CHANNELS, RGB, attach_image_stats, channels, image_keys

# Largest colour range that is scaled away, and the exposures of
# the tone-mapped error.
MAX_COLOR_RANGE = 16.0
EXPOSURES = (2.2, 1.0, 0.22)


def channel_range(df: DataFrame) -> DataFrame:
    aggregates = [f(c).alias(f"{name}_{c}") for c in channels(df) for name, f in (("min", F.min), ("max", F.max))]
    return df.groupBy(*image_keys(df)).agg(*aggregates)


def peak_color(limit: float = MAX_COLOR_RANGE) -> Column:
    """Aggregate: largest rgb value of the image, at most ``limit``."""
    return F.least(F.greatest(*[F.max(c) for c in RGB]), F.lit(limit))


def range_scale(df: DataFrame, limit: float = MAX_COLOR_RANGE) -> DataFrame:
    """Divide rgb by the image's peak, tone-map what is still above 1, clamp alpha.

    Images without a positive peak are left unscaled.
    """
    from texelframe.operators.samples import clamp, map_channels, tone_map_linear

    scaled = attach_image_stats(df, peak_color(limit).alias("_peak"))
    divisor = F.when(F.col("_peak") > 0, F.col("_peak")).otherwise(1.0)
    scaled = map_channels(scaled, lambda c: c / divisor).drop("_peak")
    return clamp(tone_map_linear(scaled), "a")


def range_scale_pairs(pairs: DataFrame, when: Column | None = None, limit: float = MAX_COLOR_RANGE) -> DataFrame:
    """Multiply the second image by the peak of the first, optionally per row."""
    scaled = attach_image_stats(pairs, peak_color(limit).alias("_peak"))
    factor = F.col("_peak") if when is None else F.when(when, F.col("_peak")).otherwise(1.0)
    return scaled.withColumns({second(c): F.col(second(c)) * factor for c in RGB}).drop("_peak")


def _squared(channel: str) -> Column:
    d = F.col(channel) - F.col(second(channel))
    return d * d


def _root_mean(square: Column) -> Column:
    return F.sqrt(F.avg(square))


def rmse_rgb(weighted: bool = False) -> Column:
    square = (_squared("r") + _squared("g") + _squared("b")) / 3
    return _root_mean(square * F.col("a") if weighted else square)


def rmse_alpha() -> Column:
    return _root_mean(_squared("a"))


def rmse_tone_mapped(exposure: float) -> Column:
    def square(c: str) -> Column:
        d = color.reinhard(F.col(c), exposure) - color.reinhard(F.col(second(c)), exposure)
        return d * d

    return _root_mean((square("r") + square("g") + square("b")) / 3)


def _unit_normal(names: list[str]) -> list[Column]:
    n = [F.col(c) * 2 - 1 for c in names]
    length = F.sqrt(n[0] * n[0] + n[1] * n[1] + n[2] * n[2])
    up = (0.0, 0.0, 1.0)
    return [F.when(length > 0, v / length).otherwise(F.lit(u)) for v, u in zip(n, up)]


def angular_error() -> Column:
    """RMS angle in radians between the packed normals of a pair."""
    first, other = _unit_normal(list(RGB)), _unit_normal([second(c) for c in RGB])
    dot = first[0] * other[0] + first[1] * other[1] + first[2] * other[2]
    angle = F.acos(color.clamp(dot, -1.0, 1.0))
    return _root_mean(angle * angle)


def psnr(rmse: Column) -> Column:
    """Peak signal-to-noise ratio; NULL for identical images."""
    return F.when(rmse > 0, F.log10(F.lit(1.0) / F.nullif(rmse, F.lit(0.0))) * 20)


def _with_rgb_report(df: DataFrame) -> DataFrame:
    rmse = F.col("rmse")
    return df.withColumns({"mse": rmse * rmse, "psnr": psnr(rmse), "identical": rmse == 0})


def diff_rgb(pairs: DataFrame, weighted: bool = False) -> DataFrame:
    """RMSE, MSE and PSNR of rgb, optionally weighted by the reference alpha."""
    return _with_rgb_report(pairs.groupBy(*image_keys(pairs)).agg(rmse_rgb(weighted).alias("rmse")))


def diff_alpha(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(*image_keys(pairs)).agg(rmse_alpha().alias("rmse_alpha"))


def _tone_columns() -> list[Column]:
    return [rmse_tone_mapped(e).alias(f"tone_{i}") for i, e in enumerate(EXPOSURES)]


def _with_tone_mean(df: DataFrame) -> DataFrame:
    return df.withColumn("tone_mean", (F.col("tone_0") + F.col("tone_1") + F.col("tone_2")) / 3)


def diff_tonemapped(pairs: DataFrame) -> DataFrame:
    return _with_tone_mean(pairs.groupBy(*image_keys(pairs)).agg(*_tone_columns()))


def diff_angular(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(*image_keys(pairs)).agg(angular_error().alias("angular_error"))


def diff_channel_weighted(pairs: DataFrame, weights: tuple[float, float, float, float]) -> DataFrame:
    """RMSE with one weight per channel."""
    square = sum((_squared(c) * w for c, w in zip(CHANNELS, weights)), F.lit(0.0)) / sum(weights)
    return pairs.groupBy(*image_keys(pairs)).agg(_root_mean(square).alias("rmse_weighted"))


def diff_report(pairs: DataFrame, weighted: bool = False, normals: bool = False, by: list[str] | None = None, extra: list[Column] | None = None) -> DataFrame:
    """All difference metrics of each pair, and any extra aggregates, in one aggregate."""
    metrics = [rmse_rgb(weighted).alias("rmse"), rmse_alpha().alias("rmse_alpha"), *_tone_columns(), *(extra or [])]
    if normals:
        metrics.append(angular_error().alias("angular_error"))
    grouped = pairs.groupBy(*(by or image_keys(pairs))).agg(*metrics)
    return _with_tone_mean(_with_rgb_report(grouped))


def histogram(
    df: DataFrame, bins: int = 1536, reduce: int = 3, exposure: float = 2.2, gamma: float = 2.2
) -> DataFrame:
    """Histogram per image and rgb channel, box-reduced; empty bins included.

    A bin's value is the mean of the bins it stands for; the last one may stand for
    fewer. Samples are counted map-side per reduced bin first. Only those counts, at most
    bins / reduce per channel, are gathered to fill in the empty bins.
    """
    def value(c: str) -> Column:
        return color.gamma_encode(F.col(c) * (1.0 / exposure), gamma)

    def bin_of(c: str) -> Column:
        fine = F.least(F.lit(bins - 1), F.floor(color.clamp(value(c)) * bins))
        return F.floor(fine / reduce).cast("int")

    keys = image_keys(df)
    entries = F.array(*[F.struct(F.lit(c).alias("channel"), bin_of(c).alias("bin")) for c in RGB])
    counts = (
        df.select(*keys, F.explode(entries).alias("e"))
        .select(*keys, "e.*")
        .groupBy(*keys, "channel", "bin")
        .agg((F.count(F.lit(1)) / F.least(F.lit(reduce), F.lit(bins) - F.col("bin") * reduce)).alias("value"))
    )
    filled = counts.groupBy(*keys, "channel").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "value"))).alias("_counts")
    )
    all_bins = F.explode(F.sequence(F.lit(0), F.lit(-(-bins // reduce) - 1)))
    return (
        filled.withColumn("bin", all_bins)
        .withColumn("value", F.coalesce(F.col("_counts")[F.col("bin")], F.lit(0.0)))
        .drop("_counts")
    )
