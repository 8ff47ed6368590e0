"""Sample operators as SQL functions, and plans of textures as SQL table functions.

Each function is the Column function of the same purpose: Spark is handed the SQL text of
the expression that it makes of the parameters, and inlines that into queries, so that no user-defined function
remains at run time and no formula is written down twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from texelframe.functions import color, quantize
from texelframe.functions.sizes import block_count, mip_count, mip_size
from texelframe.sources.formats import format_rows


def _parameters(doubles: str, ints: str = "") -> dict[str, str]:
    return dict.fromkeys(doubles.split(), "DOUBLE") | dict.fromkeys(ints.split(), "INT")


# name -> (parameters, Column function of them)
FUNCTIONS: dict[str, tuple[dict[str, str], Callable[..., Column]]] = {
    "tf_clamp": (_parameters("c low high"), color.clamp),
    "tf_scale_bias": (_parameters("c scale bias"), color.scale_bias),
    "tf_gamma_encode": (_parameters("c gamma"), color.gamma_encode),
    "tf_gamma_decode": (_parameters("c gamma"), color.gamma_decode),
    "tf_srgb_decode_unclamped": (_parameters("c"), color.srgb_decode_unclamped),
    "tf_srgb_encode_unclamped": (_parameters("c"), color.srgb_encode_unclamped),
    "tf_srgb_decode": (_parameters("c"), color.srgb_decode),
    "tf_srgb_encode": (_parameters("c"), color.srgb_encode),
    "tf_unorm": (_parameters("c", "bits"), quantize.unorm),
    "tf_snorm": (_parameters("c", "bits"), quantize.snorm),
    "tf_binary_alpha": (_parameters("a", "threshold"), quantize.above_threshold),
    "tf_premultiply": (_parameters("c a"), color.premultiply),
    "tf_demultiply": (_parameters("c a"), color.demultiply),
    "tf_slope": (_parameters("c z"), color.slope),
    "tf_tone_map": (_parameters("c r g b"), color.tone_map),
    "tf_rgbm_multiplier": (_parameters("r g b threshold"), color.rgbm_multiplier),
    "tf_rgbm_encode": (_parameters("c r g b threshold"), color.rgbm_encode),
    "tf_rgbm_alpha": (_parameters("r g b threshold"), color.rgbm_alpha),
    "tf_rgbm_decode": (_parameters("c a threshold"), color.rgbm_decode),
    "tf_normalize": (_parameters("c r g b up"), color.normalized),
    "tf_grey": (_parameters("r g b a wr wg wb wa"), color.grey),
    "tf_dither": (_parameters("a", "x y bits"), quantize.ordered_dither),
    "tf_reinhard": (_parameters("c exposure"), color.reinhard),
}


def expression(spark: SparkSession, parameters: dict[str, str], make: Callable[..., Column]) -> str:
    """SQL text of what a Column function makes of parameters of those names."""
    frame = spark.sql("SELECT " + ", ".join(f"CAST(NULL AS {kind}) AS {name}" for name, kind in parameters.items()))
    made = frame.select(make(*map(F.col, parameters)).alias("made"))
    return made._jdf.queryExecution().analyzed().expressions().head().child().sql()


def register_functions(spark: SparkSession) -> list[str]:
    """Create the functions for this session; returns their names."""
    for name, (parameters, make) in FUNCTIONS.items():
        listed = ", ".join(f"{p} {kind}" for p, kind in parameters.items())
        body = expression(spark, parameters, make)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({listed}) RETURNS DOUBLE RETURN CAST({body} AS DOUBLE)")
    return list(FUNCTIONS)


def register_table_functions(spark: SparkSession) -> list[str]:
    """Create the table functions for this session; returns their names. They go with LATERAL.

    tf_mip_plan(width, height, max_mips, min_size)   a row per level, with the level's size
    tf_size_estimate(width, height, format)          levels and compressed bytes of a texture; null bytes for an unknown format
    """
    def text(make: Callable[..., Column], *names: str) -> str:
        return expression(spark, dict.fromkeys(names, "INT"), make)

    levels = text(mip_count, "width", "height")
    mip_width, mip_height = text(mip_size, "width", "level"), text(mip_size, "height", "level")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION tf_mip_plan(width INT, height INT, max_mips INT, min_size INT)
        RETURNS TABLE (mip INT, mip_width INT, mip_height INT)
        RETURN SELECT level, {mip_width}, {mip_height}
               FROM (SELECT explode(sequence(0, greatest(1, least(max_mips, {levels})) - 1)) AS level)
               WHERE level = 0 OR ({mip_width} >= min_size AND {mip_height} >= min_size)""")

    def level_blocks(w: Column, h: Column, level: Column, bw: Column, bh: Column) -> Column:
        return block_count(mip_size(w, level), mip_size(h, level), bw, bh)

    blocks = text(level_blocks, "width", "height", "level", "block_w", "block_h")
    sizes: dict[tuple[int, int, int], list[str]] = {}
    for name, _, block_w, block_h, n_bytes, *_ in format_rows():
        sizes.setdefault((block_w, block_h, n_bytes), []).append(name)
    cases = " ".join(
        f"WHEN format IN ({', '.join(map(repr, names))}) THEN struct({w} AS block_w, {h} AS block_h, {n} AS block_bytes)" for (w, h, n), names in sizes.items()
    )
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION tf_size_estimate(width INT, height INT, format STRING)
        RETURNS TABLE (n_mips INT, total_bytes BIGINT)
        RETURN SELECT n, aggregate(sequence(0, n - 1), 0L, (total, level) -> total + block_bytes * {blocks})
               FROM (SELECT n, f.* FROM (SELECT {levels} AS n, CASE {cases} END AS f))""")
    return ["tf_mip_plan", "tf_size_estimate"]
