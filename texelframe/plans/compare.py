"""Comparison of image pairs, with the transforms their file names ask for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from texelframe.functions.names import name_tags
from texelframe.functions import color
from texelframe.operators.metrics import diff_report, peak_color, range_scale_pairs
from texelframe.operators.pairs import pair, second
from texelframe.operators.samples import map_channels
from texelframe.schema import RGB, image_keys, image_stats, join_image_stats


def apply_name_transforms(pairs: DataFrame, path: Column, basename_only: bool = False) -> DataFrame:
    """Undo on the second image what its name says was done to it.

    rgbm: decode, to linear (2.2), alpha from the reference. bc3n: red from alpha,
    blue and alpha from the reference. bc6: alpha from the reference. The tags are
    tested in that order and may stack. Adds the flag ``rgbm``.
    """
    tags = name_tags(path, basename_only)
    pairs = pairs.withColumns({f"_{t}": flag for t, flag in tags.items()})
    decoded = {
        second(c): F.when(F.col("_rgbm"), color.gamma_decode(color.rgbm_decode(F.col(second(c)), F.col("a2")), 2.2)).otherwise(
            F.col(second(c))
        )
        for c in RGB
    }
    own_alpha = F.when(F.col("_rgbm"), F.col("a")).otherwise(F.col("a2"))
    pairs = pairs.withColumns({**decoded, "a2": own_alpha})
    pairs = pairs.withColumns(
        {
            "r2": F.when(F.col("_bc3n"), F.col("a2")).otherwise(F.col("r2")),
            "b2": F.when(F.col("_bc3n"), F.col("b")).otherwise(F.col("b2")),
            "a2": F.when(F.col("_bc3n") | F.col("_bc6"), F.col("a")).otherwise(F.col("a2")),
        }
    )
    return pairs.withColumn("rgbm", F.col("_rgbm")).drop("_rgbm", "_bc3n", "_bc6")


def compare_images(
    reference: DataFrame, other: DataFrame, weighted: bool = False, normals: bool = False, rangescale: bool = False
) -> DataFrame:
    """Difference report of two sample tables, one row per image of either.

    ``code`` is null for images that cover each other. Otherwise it says why they
    can't be compared, and all metrics are null: ``missing_reference``,
    ``missing_other``, ``size`` (largest coordinates differ) or ``samples`` (of the
    same extent, but some have no partner).
    """
    keys = image_keys(reference)
    if rangescale:
        # before they are paired, so that the pairs are made and read once
        peaks = image_stats(reference, peak_color().alias("_peak"))
        scaled = join_image_stats(other, peaks, keys, "left")
        other = map_channels(scaled, lambda c: c * F.coalesce("_peak", F.lit(1.0))).drop("_peak")
    both = pair(reference.withColumn("_in", F.lit(1)), other.withColumn("_in", F.lit(1)), "full")
    ours, theirs = F.col("_in").isNotNull(), F.col(second("_in")).isNotNull()
    axes = [k for k in ("z", "y", "x") if k in reference.columns]
    extent = lambda side: F.struct(*[F.max(F.when(side, F.col(k))).alias(k) for k in axes])
    code = (
        F.when(F.count(F.when(ours, 1)) == 0, "missing_reference")
        .when(F.count(F.when(theirs, 1)) == 0, "missing_other")
        .when(extent(ours) != extent(theirs), "size")
        .when(F.count(F.when(ours & theirs, 1)) < F.count(F.lit(1)), "samples")
    )
    report = diff_report(both, weighted, normals, extra=[code.alias("code")])
    values = [c for c in report.columns if c not in (*keys, "code")]
    return report.select(*keys, *[F.when(F.col("code").isNull(), F.col(c)).alias(c) for c in values], "code")


def compare_pairs(
    pairs: DataFrame,
    path: Column | None = None,
    weighted: bool = False,
    normals: bool = False,
    rangescale: bool = False,
) -> DataFrame:
    """Difference report of paired samples.

    With ``path`` each pair is transformed as the second file's name asks; pairs
    named rgbm are range-scaled whether or not ``rangescale`` is set.
    """
    if path is not None:
        pairs = apply_name_transforms(pairs, path)
        pairs = range_scale_pairs(pairs, None if rangescale else F.col("rgbm")).drop("rgbm")
    elif rangescale:
        pairs = range_scale_pairs(pairs)
    return diff_report(pairs, weighted, normals)
