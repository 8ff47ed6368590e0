"""The conversion of a collection of textures, as one plan per step.

``convert`` brings all images to one format. ``convert_mixed`` takes the format, and what goes with it, from a
table with a row per texture, and converts a mixed collection in one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from texelframe.functions import quantize
from texelframe.functions.sizes import UNLIMITED_MIPS, mip_count, mip_size
from texelframe.operators import metrics, samples, stencil
from texelframe.plans.pyramid import pyramid, pyramid_from_source, pyramid_normal
from texelframe.schema import RGB, channels, join_image_stats
from texelframe.session import cut_lineage
from texelframe.sources.formats import format_rows, storage, with_format


def prepare_rgbm(df: DataFrame, rangescale: bool = True, gamma: bool = True, encode: bool = True) -> DataFrame:
    """HDR colour to RGBM: range scaling, sRGB, then colour times multiplier."""
    if rangescale:
        df = metrics.range_scale(df)
    if gamma:
        df = samples.to_srgb_unclamped(df)
    return samples.to_rgbm(df) if encode else df


def quantize_stored(df: DataFrame) -> DataFrame:
    """Round channels to what each image's ``storage`` code says; channels that aren't stored are null."""
    code = F.col("storage")
    rounded = {c: quantize.stored_colour(F.col(c), code, c == "r") for c in channels(df) if c != "a"}
    if "a" in df.columns:
        rounded["a"] = quantize.stored_alpha(F.col("a"), F.col("x"), F.col("y"), code)
    return df.withColumns(rounded)


def quantize_for_format(
    df: DataFrame,
    format: str,
    alpha_dithering: bool = False,
    alpha_bits: int | None = None,
    luminance: bool = False,
    alpha: bool | None = None,
) -> DataFrame:
    """Round channels to what the target format stores.

    bc1a keeps one bit of alpha; dithered alpha has 4 bits in bc2, and 8 elsewhere, where it needs
    ``alpha``, unless told otherwise; signed formats use signed fractions; bc6 stores floats
    and is left alone; luminance keeps red only.
    """
    if format not in {row[0] for row in format_rows()}:
        raise ValueError(f"unknown format {format!r}")
    if alpha_bits is not None:
        quantize.check_bits(alpha_bits, high=8)
    # all literals: what is left of the code's cases is the format's own
    code = storage(F.lit(format), F.lit(alpha_dithering), F.lit(alpha).cast("boolean"), F.lit(alpha_bits).cast("int"), F.lit(luminance))
    out = quantize_stored(df.withColumn("storage", code)).drop("storage")
    return samples.luminance(out) if luminance or format == "lumi" else out


def convert(
    df: DataFrame,
    format: str = "bc7",
    mip_filter: str = "box",
    gamma: bool = True,
    wrap: str = "clamp",
    rgbm: bool = False,
    rangescale: bool = False,
    to_normal: bool = False,
    normal: bool = False,
    renormalize: bool = True,
    max_mips: int = UNLIMITED_MIPS,
    min_size: int = 1,
    alpha_dithering: bool = False,
    alpha_bits: int | None = None,
    reuse_levels: bool | None = None,
    alpha: bool | None = None,
) -> DataFrame:
    """Every level of every texture, rounded to what the format stores.

    The stages of a conversion run in their usual order: HDR preparation (for
    bc3_rgbm without the multiplier, which that format adds itself), normal map
    from colour, pyramid, quantisation. Stored levels are kept up to the first
    gap of a face, unless ``reuse_levels`` is false; with ``rgbm``, bc3_rgbm and
    ``to_normal``, which make another image, all levels are made from level 0. The format lumi keeps red only.
    """
    changed = rgbm or format == "bc3_rgbm" or to_normal
    if reuse_levels and changed:
        raise ValueError("levels of the source are no levels of the image that is made from it")
    reuse = "mip" in df.columns and not changed and reuse_levels is not False
    if changed and "mip" in df.columns:
        df = df.filter(F.col("mip") == 0)
    if rgbm or format == "bc3_rgbm":
        df = prepare_rgbm(df, rangescale, gamma, encode=format != "bc3_rgbm")
    if to_normal:
        df = samples.pack_normals(stencil.color_to_normal(df, wrap))
    if changed:
        df = cut_lineage(df)  # levels read it several times
    if reuse:
        levels = pyramid_from_source(df, mip_filter, gamma, wrap, max_mips, min_size, normal, renormalize)
    elif normal or to_normal:
        levels = pyramid_normal(df, mip_filter, wrap, renormalize, max_mips, min_size)
    else:
        levels = pyramid(df, mip_filter, gamma, wrap, max_mips, min_size)
    return quantize_for_format(levels, format, alpha_dithering, alpha_bits, format == "lumi", alpha)


def _or(textures: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in textures.columns else F.lit(None).cast(kind)


def plan_conversion(textures: DataFrame, max_mips: int = UNLIMITED_MIPS, min_size: int = 1) -> DataFrame:
    """What the conversion of each texture does, one row each.

    textures: texture_id, width, height, the target ``format`` and, where they differ from none, alpha_mode (the
    file's), alpha (true or false where the user says so), alpha_dithering, alpha_bits, rgbm. Added or
    settled are alpha_mode, rgbm, n_mips, dds10, ``storage`` and ``code``, the reason why a texture can't be converted.
    """
    known = with_format(textures)
    alpha, bits = _or(textures, "alpha", "boolean"), _or(textures, "alpha_bits", "int")
    code = (
        F.when(F.col("block_bytes").isNull(), "format")
        .when(~bits.between(1, 8), "alpha_bits")
        .when(~F.coalesce((F.col("width") > 0) & (F.col("height") > 0), F.lit(False)), "size")
    )
    settled = known.withColumns({
        "rgbm": F.coalesce(_or(textures, "rgbm", "boolean"), F.lit(False)) | F.coalesce(F.col("format") == "bc3_rgbm", F.lit(False)),
        "storage": storage(F.col("format"), _or(textures, "alpha_dithering", "boolean"), alpha, bits, F.lit(False)),
        "n_mips": mip_count(F.col("width"), F.col("height"), max_mips, min_size),
        "code": code,
        "alpha_mode": _or(textures, "alpha_mode", "string"),
    })
    # the multiplier takes the place of alpha, but for the format that adds it by itself
    opaque = F.col("rgbm") & (F.col("format") != "bc3_rgbm")
    named = samples.resolve_alpha_mode(settled, alpha)
    named = named.withColumn("alpha_mode", F.when(opaque, "none").otherwise(F.col("alpha_mode")))
    return named.drop("family", "block_w", "block_h", "block_bytes", "pixel_type")


def conversion_faults(df: DataFrame, textures: DataFrame) -> DataFrame:
    """(texture_id, code) of textures that ``convert_mixed`` leaves out: by their row, or for want of one."""
    planned = plan_conversion(textures).filter("code IS NOT NULL").select("texture_id", "code")
    unnamed = df.select("texture_id").distinct().join(textures.select("texture_id"), "texture_id", "left_anti")
    return planned.unionByName(unnamed.withColumn("code", F.lit("texture")))


def convert_mixed(
    df: DataFrame,
    textures: DataFrame,
    mip_filter: str = "box",
    gamma: bool = True,
    wrap: str = "clamp",
    rangescale: bool = True,
    max_mips: int = UNLIMITED_MIPS,
    min_size: int = 1,
) -> DataFrame:
    """Every level of every texture, each rounded to what its own format stores (see plan_conversion).

    Textures share one job whatever their formats: a code rides along with the samples and is
    read by a CASE over the format dimension. Only images that become RGBM go a way of
    their own. Stored levels of the others are reused. Channels that a format doesn't store are null.
    Textures with a fault are left out (see conversion_faults). Sizes are those of ``textures``: samples beyond
    them belong to no image.
    """
    plan = plan_conversion(textures, max_mips, min_size).filter("code IS NULL")
    per_texture = plan.select(
        "texture_id", "storage", "rgbm", F.col("format").alias("_format"), F.col("width").alias("_w"), F.col("height").alias("_h"),
        (F.col("height") - 1).alias("_last_y"), (F.col("width") - 1).alias("_last_x"),
        *([(F.col("depth") - 1).alias("_last_z")] if "depth" in plan.columns else []),
    )
    at_level = df if "mip" in df.columns else df.withColumn("mip", F.lit(0))
    rows = join_image_stats(at_level, per_texture, ["texture_id"])
    sizes = {side: mip_size(F.col(f"_{side[0]}"), F.col("mip")) for side in ("width", "height")}
    rows = rows.withColumns(sizes).drop("_w", "_h")
    plain = pyramid_from_source(rows.filter("NOT rgbm").drop("rgbm", "_format"), mip_filter, gamma, wrap, max_mips, min_size)
    four = (*RGB, "a")
    prepared = prepare_rgbm(rows.filter("rgbm AND mip = 0"), rangescale, gamma, encode=False)
    coded = samples.to_rgbm(prepared.withColumn("_plain", F.struct(*four)))
    adds_it = F.col("_format") == "bc3_rgbm"
    own = {c: F.when(adds_it, F.col(f"_plain.{c}")).otherwise(F.col(c)) for c in four}
    made = cut_lineage(coded.withColumns(own).drop("_plain", "rgbm", "_format"))
    levels = plain.unionByName(pyramid(made, mip_filter, gamma, wrap, max_mips, min_size))
    return quantize_stored(levels).drop("storage")
