"""One query per operator, with the equivalent SQL where there is one.

Doubles are cut to six decimals on both sides; sums may differ in their last bits.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from texelframe.functions import names as fn_names
from texelframe.functions import sizes as fn_sizes
from texelframe.functions.sql import register_functions, register_table_functions
from texelframe.operators import batches, detach, metrics, pairs, resample, samples, stencil, stitch, tiles
from texelframe.operators.placement import wrap
from texelframe.plans import compare, convert
from texelframe.plans import pyramid as pyramids
from texelframe.schema import with_default_keys
from texelframe.session import cut_lineage, shared_folder
from texelframe.sources import files as file_source
from texelframe.sources import formats, images, tables
from workload import fixtures as fx
from workload import sql as q

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def six_decimals(df: DataFrame) -> DataFrame:
    """Round as ``workload.sql.r6`` does."""
    doubles = [f.name for f in df.schema if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.floor(F.col(c) * 1000000 + 0.4142) / 1000000 for c in doubles})


def register(name: str, run: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    def rounded(spark: SparkSession, folder: str) -> DataFrame:
        return six_decimals(run(spark, folder))

    QUERIES[name] = rounded
    if sql is not None:
        ORACLES[name] = sql


def on(fixture: Callable, transform: Callable[[DataFrame], DataFrame]) -> Callable:
    """A query that transforms one fixture."""
    return lambda spark, folder: transform(fixture(spark, folder))


def sample_sql(fixture: str, **channels: str) -> str:
    """Samples of a fixture with some channels replaced."""
    values = {c: channels.get(c, c) for c in "rgba"}
    return q.query(f"SELECT texture_id, y, x, {q.rounded(**values)} FROM {fixture}", fixture)


def rgb(make: Callable[[str], str]) -> dict[str, str]:
    return {c: make(c) for c in "rgb"}


def stored_textures(spark: SparkSession, folder: str) -> DataFrame:
    """px with part of its levels stored: 1 for very bright images, never 2, always 3."""
    base = with_default_keys(fx.px(spark, folder)).drop("z", "layer")
    from texelframe.schema import attach_image_stats, with_size

    base = with_size(base)
    first = resample.next_mip(base, "max")
    bright = attach_image_stats(first, F.max("r").alias("_peak")).filter("_peak > 30.3").drop("_peak")
    third = resample.next_mip(resample.next_mip(first, "min"), "min")
    columns = base.columns
    levels = base.unionByName(bright.select(*columns)).unionByName(third.select(*columns))
    return cut_lineage(levels)  # stands for a stored table


# --- scans, sources, sinks -------------------------------------------------------------

register("s1_scan_files", lambda s, d: file_source.scan_files(s, d).select("name", "n_bytes"))
register(
    "s2_output_path",
    on(fx.files, lambda d: file_source.with_output_path(d, ".dds", F.when(F.col("doc_id") < 500, F.col("dir"))
       .otherwise(F.concat("dir", F.lit("_out")))).select("doc_id", "out_path")),
    q.query("""
        SELECT doc_id, CASE WHEN out = concat(dir, '/', name) THEN regexp_replace(out, '\\.dds$', '_out.dds')
                            ELSE out END AS out_path
        FROM (SELECT *, concat(CASE WHEN doc_id < 500 THEN dir ELSE concat(dir, '_out') END, '/',
                               regexp_replace(name, '\\.[a-z]+$', ''), '.dds') AS out FROM files)""", "files"),
)
register(
    "s3_container_magic",
    on(fx.contents, lambda d: d.select("doc_id", fn_names.is_container(F.col("content")).alias("is_container"))),
    "SELECT doc_id, doc_id % 3 = 0 OR starts_with(text, 'DDS ') AS is_container FROM documents",
)
RAW_SQL = q.query(f"SELECT texture_id, 4 AS width, 4 AS height, y, x, {q.rounded(r='r', g='g', b='b', a='a')} FROM raw", "raw")
register("s4_image_samples", on(fx.image_rows, images.image_samples), RAW_SQL)
FAULT_SQL = "CASE WHEN texture_id % 11 = 3 OR (texture_id % 5 <> 1 AND texture_id % 7 = 2) THEN 'decode' WHEN texture_id % 5 = 1 THEN 'size' END"
register(
    "s4_checked_samples", on(fx.broken_image_rows, images.checked_samples),
    q.query(f"""
        SELECT texture_id, NULL AS code, 4 AS width, 4 AS height, y, x, {q.rounded(r='r', g='g', b='b', a='a')} FROM raw WHERE {FAULT_SQL} IS NULL
        UNION ALL
        SELECT vec_id, code, 0, 0, NULL, NULL, NULL, NULL, NULL, NULL
        FROM (SELECT vec_id, {FAULT_SQL.replace('texture_id', 'vec_id')} AS code FROM embeddings) WHERE code IS NOT NULL""", "raw"),
)
register("s5_explode_raw", on(fx.raw_buffers, lambda d: images.explode_raw(d, 4, 4)), RAW_SQL)


def _write_and_read(spark: SparkSession, folder: str) -> DataFrame:
    path = os.path.join(shared_folder(spark), "pixels-" + uuid.uuid4().hex)
    tables.write_pixels(fx.px(spark, folder), path)
    stored = tables.read_pixels(spark, path)
    return samples.planes(stored, 0, 0).select("texture_id", "face", "mip", "y", "x", *"rgba")


register(
    "s6_write_read_pixels", _write_and_read,
    q.query(f"SELECT texture_id, 0 AS face, 0 AS mip, y, x, {q.rounded(r='r', g='g', b='b', a='a')} FROM px", "px"),
)
register(
    "s7_extract_planes",
    lambda s, d: tables.extract_planes(
        stored_textures(s, d), F.concat(F.lit("out/t"), F.col("texture_id").cast("string"), F.lit(".dds")), mips=True
    ).groupBy("out_name").agg(F.count("*").alias("n_samples"), F.max("r").alias("max_r")),
    None,
)
register(
    "s8_scan_report",
    lambda s, d: file_source.scan_report(
        fx.files(s, d).select(F.concat_ws("/", "dir", "name").alias("path")),
        fx.files(s, d).select(
            F.concat_ws("/", "dir", "name").alias("path"),
            F.when(F.col("n_bytes") < 500, 0).otherwise(F.col("n_bytes")).alias("n_bytes"),
        ),
    ),
    q.query("SELECT concat(dir, '/', name) AS path FROM files WHERE n_bytes < 500", "files"),
)
def _fault_report(spark: SparkSession, folder: str) -> DataFrame:
    """Every reason why a file gives no image: missing, empty or undecodable."""
    listed = fx.files(spark, folder).withColumn("path", F.concat_ws("/", "dir", "name"))
    n_bytes = F.when(F.col("n_bytes") < 500, 0).otherwise(F.col("n_bytes"))
    rows = listed.select("path", F.col("doc_id").alias("texture_id")).join(fx.broken_image_rows(spark, folder), "texture_id")
    faults = rows.withColumn("code", images.decode_fault()).filter("code IS NOT NULL").select("path", "code")
    return file_source.scan_report(listed, listed.filter("doc_id % 13 <> 4").withColumn("n_bytes", n_bytes), faults)


register(
    "s8_fault_report", _fault_report,
    q.query(f"""
        SELECT path, code FROM (
            SELECT concat(dir, '/', name) AS path,
                   coalesce((SELECT {FAULT_SQL.replace('texture_id', 'vec_id')} FROM embeddings WHERE vec_id = doc_id),
                            CASE WHEN doc_id % 13 = 4 THEN 'missing' WHEN n_bytes < 500 THEN 'empty' END) AS code
            FROM files) WHERE code IS NOT NULL""", "files"),
)
register(
    "s9_catalog", on(fx.textures, tables.catalog),
    q.query("SELECT texture_id, width, height, depth, format FROM textures", "textures"),
)
register(
    "s9_catalog_summary", on(fx.textures, tables.catalog_summary),
    q.query("""
        SELECT format, width, height, count(*) AS n_textures,
               CAST(sum(CAST(width AS BIGINT) * height) AS BIGINT) AS total_pixels,
               max(CAST(width AS BIGINT) * height) AS max_pixels,
               CAST(grouping_id(format, width, height) AS INT) AS level
        FROM textures GROUP BY ROLLUP (format, width, height)""", "textures"),
)

# --- per-sample operators ----------------------------------------------------------------

register("p1_scale_bias", on(fx.px, lambda d: samples.scale_bias(d, "r", 0.5, 0.25)), sample_sql("px", r="r * 0.5e0 + 0.25e0"))
register("p2_clamp", on(fx.px, lambda d: samples.clamp(d, "r", 0.25, 16.0)), sample_sql("px", r="greatest(0.25e0, least(16e0, r))"))
register(
    "p3_tone_map_linear", on(fx.px, samples.tone_map_linear),
    sample_sql("px", **rgb(lambda c: f"CASE WHEN {q.peak()} > 1 THEN {c} / {q.peak()} ELSE {c} END")),
)
register("p4_to_gamma", on(fx.px, lambda d: samples.to_gamma(d, 2.2)), sample_sql("px", **rgb(lambda c: f"pow(greatest(0e0, {c}), 1 / 2.2e0)")))
register("p5_to_linear", on(fx.px, lambda d: samples.to_linear(d, 2.2)), sample_sql("px", **rgb(lambda c: f"pow(greatest(0e0, {c}), 2.2e0)")))
register("p6_to_srgb", on(fx.px, samples.to_srgb), sample_sql("px", **rgb(lambda c: q.linear_to_srgb(q.clamp01(c)))))
register("p7_to_linear_from_srgb", on(fx.px, samples.to_linear_from_srgb), sample_sql("px", **rgb(lambda c: q.srgb_to_linear(q.clamp01(c)))))


def _signed(df: DataFrame) -> DataFrame:
    """px4 stretched around zero, so that negative values occur."""
    return samples.map_channels(df, lambda c: c * 4 - 2)


SIGNED = {c: f"({c} * 4 - 2)" for c in "rgba"}
register(
    "p8_to_srgb_unclamped", on(fx.px4, lambda d: samples.to_srgb_unclamped(_signed(d))),
    sample_sql("px4", **rgb(lambda c: q.mirrored(q.linear_to_srgb, SIGNED[c]))),
)
register(
    "p9_to_linear_from_srgb_unclamped", on(fx.px4, lambda d: samples.to_linear_from_srgb_unclamped(_signed(d))),
    sample_sql("px4", **rgb(lambda c: q.mirrored(q.srgb_to_linear, SIGNED[c]))),
)
register("p10_premultiply", on(fx.px, samples.premultiply), sample_sql("px", **rgb(lambda c: f"{c} * a")))
register(
    "p11_demultiply", on(fx.px, lambda d: samples.demultiply(samples.premultiply(d), 1e-12)),
    sample_sql("px", **rgb(lambda c: f"{c} * a / greatest(a, 1e-12)")),
)
M = f"least(1e0, greatest(0.15e0, {q.peak()}))"
register(
    "p12_to_rgbm", on(fx.px, samples.to_rgbm),
    sample_sql("px", **rgb(lambda c: q.clamp01(f"{c} / {M}")), a=f"({M} - 0.15e0) / 0.85e0"),
)
register("p13_from_rgbm", on(fx.px, samples.from_rgbm), sample_sql("px", **rgb(lambda c: f"{c} * (a * 0.85e0 + 0.15e0)"), a="1e0"))
GREY = "(2 * r + 4 * g + b) / 7e0"
register("p14_to_grey", on(fx.px, lambda d: samples.to_grey(d, 2.0, 4.0, 1.0, 0.0)), sample_sql("px", r=GREY, g=GREY, b=GREY, a=GREY))
register("p15_copy_channel", on(fx.px, lambda d: samples.copy_channel(d, "r", "a")), sample_sql("px", a="r"))
register(
    "p16_copy_channel_from",
    lambda s, d: pairs.copy_channel_from(fx.px(s, d), fx.px_low(s, d), "b", "g").select("texture_id", "y", "x", *"rgba"),
    q.query(f"SELECT texture_id, y, x, {q.rounded(r='r', g='b2', b='b', a='a')} FROM px_pair", "px_pair"),
)
register(
    "p17_add_channel",
    lambda s, d: pairs.add_channel(fx.px(s, d), fx.px_low(s, d), "r", "r", -1.0).select("texture_id", "y", "x", *"rgba"),
    q.query(f"SELECT texture_id, y, x, {q.rounded(r='r - r2', g='g', b='b', a='a')} FROM px_pair", "px_pair"),
)
register("p18_abs_channel", on(fx.px4, lambda d: samples.abs_channel(_signed(d), "r")), sample_sql("px4", r=f"abs{SIGNED['r']}", g=SIGNED["g"], b=SIGNED["b"]))
register(
    "p19_normalize_normals", on(fx.px4, samples.normalize_normals),
    q.query(f"SELECT texture_id, y, x, {q.rounded(r='r', g='g', b='b', a='a')} FROM n", "px4", ctes=[("n", q.normalized("px4"))]),
)
register("p20_pack_normals", on(fx.px4, lambda d: samples.pack_normals(_signed(d))), sample_sql("px4", **rgb(lambda c: f"{SIGNED[c]} * 0.5e0 + 0.5e0")))
register(
    "p21_to_slope_space", on(fx.px, samples.to_slope_space),
    sample_sql("px", **{c: f"CASE WHEN b = 0 THEN {c} ELSE 0.5e0 * ((2 * {c} - 1) / b) + 0.5e0 END" for c in "rg"}),
)
register("p22_quantize_unorm", on(fx.px, lambda d: samples.quantize_unorm(d, 5)), sample_sql("px", **{c: q.unorm(c, 5) for c in "rgba"}))
register(
    "p23_quantize_snorm", on(fx.px4, lambda d: samples.quantize_snorm(_signed(d), 8)),
    sample_sql("px4", **{c: f"floor(least(1e0, greatest(-1e0, {SIGNED[c] if c != 'a' else c})) * 127 + 0.5e0) / 127" for c in "rgba"}),
)
register(
    "p24_binary_alpha", on(fx.px, samples.binary_alpha),
    sample_sql("px", a=f"CASE WHEN floor({q.clamp01('a')} * 255 + 0.5e0) > 127 THEN 1e0 ELSE 0e0 END"),
)
DITHER = "[[0, 8, 2, 10], [12, 4, 14, 6], [3, 11, 1, 9], [15, 7, 13, 5]][y % 4 + 1][x % 4 + 1] / 16e0"
register("p25_dither_alpha", on(fx.px, lambda d: samples.dither_alpha(d, 4)), sample_sql("px", a=f"floor({q.clamp01('a')} * 15 + {DITHER}) / 15"))
register("p26_luminance", on(fx.px, samples.luminance), q.query(f"SELECT texture_id, y, x, {q.rounded(r='r')} FROM px", "px"))
register(
    "p27_undo_bc3n", on(fx.px_pair, lambda d: pairs.undo_bc3n(d).select("texture_id", "y", "x", "r2", "g2", "b2", "a2")),
    q.query(f"SELECT texture_id, y, x, {q.rounded(r2='a2', g2='g2', b2='b', a2='a')} FROM px_pair", "px_pair"),
)
register(
    "p28_resolve_alpha_mode",
    on(fx.parts, lambda d: samples.resolve_alpha_mode(
        d.withColumn("format", F.when(F.col("mip") == 2, "bc6").otherwise(F.col("format"))),
        F.when(F.col("layer") == 1, F.col("face") > 1),
    ).select("file", "alpha_mode")),
    q.query("""
        SELECT file, CASE WHEN mip = 2 THEN 'none' WHEN layer = 1 AND face > 1 THEN 'transparency'
                          WHEN layer = 1 THEN 'none' ELSE alpha_mode END AS alpha_mode FROM parts""", "parts"),
)
register(
    "p29_name_tags", on(fx.files, lambda d: d.select("doc_id", *[c.alias(t) for t, c in fn_names.name_tags(F.col("name")).items()])),
    q.query("SELECT doc_id, name LIKE '%rgbm%' AS rgbm, name LIKE '%bc3n%' AS bc3n, name LIKE '%bc6%' AS bc6 FROM files", "files"),
)
register(
    "p30_planes", on(fx.parts, lambda d: samples.planes(d, 0, 0).select("file", "layer", "face", "mip")),
    q.query("SELECT file, layer, face, mip FROM parts WHERE face = 0 AND mip = 0", "parts"),
)

# --- neighbourhoods ------------------------------------------------------------------------

register(
    "n1_wrap",
    on(fx.px, lambda d: d.select("texture_id", "y", "x", *[
        wrap(F.col("x") + o, F.lit(16), m).alias(f"{m}_{n}") for m in ("clamp", "repeat") for n, o in (("left", -9), ("right", 9))
    ])),
    q.query("""
        SELECT texture_id, y, x, greatest(0, x - 9) AS clamp_left, least(15, x + 9) AS clamp_right,
               CAST((x + 7) % 16 AS INT) AS repeat_left, CAST((x + 9) % 16 AS INT) AS repeat_right FROM px""", "px"),
)
NORMAL_COLUMNS = ("texture_id", "y", "x", "r", "g", "b", "a")


def normal_sql(fixture: str, source: str, weights, ctes=(), mode: str = "clamp", pack: bool = False) -> str:
    rounded = q.rounded(**{c: f"{c} * 0.5e0 + 0.5e0" if pack else c for c in "rgb"}, a="a")
    made = [*ctes, *q.normal_map_ctes("nm", source, weights, mode)]
    return q.query(f"SELECT texture_id, y, x, {rounded} FROM nm", fixture, ctes=made)


for mode in ("clamp", "repeat"):
    register(
        f"n2_to_normal_map_{mode}",
        on(fx.hm_alpha, lambda d, mode=mode: stencil.to_normal_map(d, 1.0, 0.5, 0.25, 0.125, mode).select(*NORMAL_COLUMNS)),
        normal_sql("hma", "hma", (1.0, 0.5, 0.25, 0.125), mode=mode),
    )
register(
    "n3_color_to_normal", on(fx.px4, lambda d: stencil.color_to_normal(d).select(*NORMAL_COLUMNS)),
    normal_sql("px4", "grey", tuple(w / 1.875 for w in (1, 0.5, 0.25, 0.125)),
               [("grey", "SELECT texture_id, y, x, (r + g + b) / 3 AS a FROM px4")]),
)
register(
    "n4_height_to_packed_normal", on(fx.px4, lambda d: stencil.height_to_packed_normal(d).select(*NORMAL_COLUMNS)),
    normal_sql("px4", "grey", (2.0, 1.0, 1.0, 1.0),
               [("grey", f"SELECT texture_id, y, x, 0.2e0 * {GREY} AS a FROM px4")], pack=True),
)

# --- resampling and pyramids -----------------------------------------------------------------

register(
    "m1_mip_count",
    on(fx.textures, lambda d: d.select("texture_id", *[
        fn_sizes.mip_count(F.col("width"), F.col("height"), m, s).alias(n)
        for n, m, s in (("all_mips", 32, 1), ("capped", 4, 1), ("no_small", 32, 16), ("zero_cap", 0, 1))
    ])),
    q.query("SELECT texture_id, " + ", ".join(
        f"{q.mip_count('width', 'height', m, s)} AS {n}"
        for n, m, s in (("all_mips", 32, 1), ("capped", 4, 1), ("no_small", 32, 16), ("zero_cap", 0, 1))
    ) + " FROM textures", "textures"),
)
PLAN_SQL = ("plan", f"""
    SELECT texture_id, format, depth, mip, greatest(1, width >> mip) AS mip_width, greatest(1, height >> mip) AS mip_height
    FROM (SELECT *, CAST(unnest(range(0, {q.mip_count('width', 'height', 32, 1)})) AS INT) AS mip FROM textures)""")
register(
    "m2_mip_plan", on(fx.textures, lambda d: formats.mip_plan(d).select("texture_id", "mip", "mip_width", "mip_height")),
    q.query("SELECT texture_id, mip, mip_width, mip_height FROM plan", "textures", ctes=[PLAN_SQL]),
)


def resize_sql(fixture: str, filter: str, channels: str = "rgba", **options) -> str:
    values = q.rounded(**{c: c for c in channels})
    made = q.resize_ctes("small", fixture, filter, channels, **options)
    return q.query(f"SELECT texture_id, y, x, {values} FROM small", fixture, ctes=made)


def sample_columns(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in ("texture_id", "face", "mip", "y", "x", *"rgba") if c in df.columns])


for key, name in (("m3", "box"), ("m4", "min"), ("m4", "max"), ("m5", "triangle"), ("m5", "mitchell"), ("m6", "kaiser")):
    register(f"{key}_next_mip_{name}", on(fx.px, lambda d, name=name: sample_columns(resample.next_mip(d, name))), resize_sql("px", name))
register(
    "m6_next_mip_kaiser_repeat", on(fx.px, lambda d: sample_columns(resample.next_mip(d, "kaiser", "repeat"))),
    resize_sql("px", "kaiser", wrap="repeat"),
)
register("m7_resize_box", on(fx.px, lambda d: sample_columns(resample.resize(d, 7, 5))), resize_sql("px", "box", out=("7", "5")))
THUMBS = [("kaiser", "clamp"), ("kaiser", "repeat"), ("mitchell", "clamp"), ("mitchell", "repeat")]


def _thumbs(px: DataFrame) -> DataFrame:
    """Images at an eighth of their side, by two filters and both ways beyond the edge."""
    each = [sample_columns(resample.resize(px, 2, 2, name, wrap)).withColumn("way", F.lit(f"{name} {wrap}")) for name, wrap in THUMBS]
    return each[0].unionByName(each[1]).unionByName(each[2]).unionByName(each[3])


register(
    "m7_resize_thumb", on(fx.px, _thumbs),
    " UNION ALL ".join(f"SELECT *, '{name} {wrap}' AS way FROM ({resize_sql('px', name, out=('2', '2'), wrap=wrap)})" for name, wrap in THUMBS),
)
register("m7_resize_up", on(fx.hm_alpha, lambda d: sample_columns(resample.resize(d, 13, 11, "mitchell"))), resize_sql("hma", "mitchell", "a", out=("13", "11")))


def pyramid_sql(fixture: str, filter: str, levels: int, before=None, after=None, step=None, base=None) -> str:
    """Base rows, then every level of the chain, with conversions around the chain."""
    before, after = before or (lambda c: c), after or (lambda c: c)
    start = ("start", f"SELECT texture_id, y, x, {', '.join(f'{before(c)} AS {c}' for c in 'rgb')}, a FROM {fixture}")
    ctes, names = q.chain_ctes("lv", "start", filter, levels, step=step)
    kept = base or (lambda c: c)
    selects = [f"SELECT texture_id, 0 AS mip, y, x, {q.rounded(**{c: kept(c) for c in 'rgb'}, a='a')} FROM {fixture}"]
    selects += [
        f"SELECT texture_id, {k} AS mip, y, x, {q.rounded(**{c: after(c) for c in 'rgb'}, a='a')} FROM {n}"
        for k, n in enumerate(names, 1)
    ]
    return q.query(" UNION ALL ".join(selects), fixture, ctes=[start, *ctes])


def to_lin(c: str) -> str:
    return q.mirrored(q.srgb_to_linear, c)


def to_s(c: str) -> str:
    return q.mirrored(q.linear_to_srgb, c)


register("m8_pyramid_box", on(fx.px, lambda d: sample_columns(pyramids.pyramid(d))), pyramid_sql("px", "box", 4, to_lin, to_s))
register(
    "m8_pyramid_kaiser", on(fx.px4, lambda d: sample_columns(pyramids.pyramid(d, "kaiser"))),
    pyramid_sql("px4", "kaiser", 2, to_lin, to_s),
)
register(
    "m9_pyramid_alpha", on(fx.px, lambda d: sample_columns(pyramids.pyramid_alpha(d))),
    pyramid_sql("px", "box", 4, lambda c: f"{q.srgb_to_linear(q.clamp01(c))} * a",
                lambda c: q.linear_to_srgb(q.clamp01(f"{c} / greatest(a, 1e-12)"))),
)
register(
    "m10_pyramid_normal", on(fx.px4, lambda d: sample_columns(pyramids.pyramid_normal(d))),
    pyramid_sql("px4", "box", 2, step=q.normalized),
)


def slope(c: str) -> str:
    return c if c == "b" else f"(CASE WHEN b = 0 THEN {c} ELSE 0.5e0 * ((2 * {c} - 1) / b) + 0.5e0 END)"


register(
    "m11_pyramid_slope", on(fx.px4, lambda d: sample_columns(pyramids.pyramid_slope(d))),
    pyramid_sql("px4", "kaiser", 2, slope, base=slope),
)


def _from_source_levels(source: str = "px", normal: bool = False) -> tuple[list[tuple[str, str]], list[tuple]]:
    """CTEs, and (mip, CTE, way back from the state of the chain) of its levels.

    Level 1 is stored for bright images only and 2 never, so all from there is generated.
    """
    lin = (lambda c: c) if normal else to_lin
    back = (lambda c: c) if normal else to_s
    stored1 = q.resize_ctes("st", source, "max", where="n_w > 1 OR n_h > 1")
    kept1 = ("kept1", "SELECT * FROM st WHERE texture_id IN (SELECT texture_id FROM st GROUP BY 1 HAVING max(r) > 30.3e0)")
    linear = ", ".join(f"{lin(c)} AS {c}" for c in "rgb")
    start = ("start", f"SELECT texture_id, y, x, {linear}, a FROM {source} WHERE texture_id NOT IN (SELECT texture_id FROM kept1)")
    made1 = q.resize_ctes("mk", "start", "box", where="n_w > 1 OR n_h > 1")
    made = "mk"
    if normal:
        made1, made = [*made1, ("mkn", q.normalized("mk"))], "mkn"
    second = ("lv1", f"SELECT texture_id, y, x, {linear}, a FROM kept1 UNION ALL SELECT texture_id, y, x, r, g, b, a FROM {made}")
    ctes, names = q.chain_ctes("up", "lv1", "box", 3, step=q.normalized if normal else None)
    same = lambda c: c
    levels = [(0, source, same), (1, "kept1", same), (1, made, back), *((k, n, back) for k, n in enumerate(names, 2))]
    return [*stored1, kept1, start, *made1, second, *ctes], levels


ODD_ALPHA = (0.97, 0.0123)  # of a mean of alpha, no half of an 8-bit step
PX_ODD = ("px_odd", f"SELECT texture_id, y, x, r, g, b, a * {ODD_ALPHA[0]}e0 + {ODD_ALPHA[1]}e0 AS a FROM px")


def _from_source_sql(source: str = "px", normal: bool = False, stored: Callable[[str], str | None] = lambda c: c) -> str:
    """All levels; ``stored`` makes of a channel's value what is stored, or nothing."""
    ctes, levels = _from_source_levels(source, normal)
    ctes = [PX_ODD, *ctes]
    selects = []
    for mip, name, back in levels:
        values = {c: stored(back(c) if c != "a" else c) for c in "rgba" if stored(c) is not None}
        selects.append(f"SELECT texture_id, 0 AS face, {mip} AS mip, y, x, {q.rounded(**values)} FROM {name}")
    return q.query(" UNION ALL ".join(selects), "px", ctes=ctes)


register(
    "m12_pyramid_from_source",
    lambda s, d: sample_columns(pyramids.pyramid_from_source(stored_textures(s, d))),
    _from_source_sql(),
)
register(
    "m12_pyramid_normal_from_source",
    lambda s, d: sample_columns(pyramids.pyramid_from_source(stored_textures(s, d), normal=True)),
    _from_source_sql(normal=True),
)
ORACLES["s7_extract_planes"] = q.query(
    "SELECT concat('out/t', CAST(texture_id AS VARCHAR), '_mipmap', CAST(mip AS VARCHAR), '.tga') AS out_name,"
    f" count(*) AS n_samples, {q.r6('max(r)')} AS max_r FROM (SELECT texture_id, 0 AS mip, r FROM px"
    " UNION ALL SELECT texture_id, 1, r FROM kept1 UNION ALL SELECT texture_id, 3, r FROM th)"
    " GROUP BY texture_id, mip",
    "px",
    ctes=[
        *q.resize_ctes("st", "px", "max"),
        ("kept1", "SELECT * FROM st WHERE texture_id IN (SELECT texture_id FROM st GROUP BY 1 HAVING max(r) > 30.3e0)"),
        *q.resize_ctes("se", "st", "min"), *q.resize_ctes("th", "se", "min"),
    ],
)

# --- aggregates and metrics --------------------------------------------------------------------

register(
    "a1_channel_range", on(fx.px, metrics.channel_range),
    q.query("SELECT texture_id, " + q.rounded(**{f"{f}_{c}": f"{f}({c})" for c in "rgba" for f in ("min", "max")}) + " FROM px GROUP BY 1", "px"),
)
PEAKS = ("peaks", "SELECT texture_id, least(16e0, greatest(max(r), max(g), max(b))) AS p FROM px GROUP BY 1")
SCALED_PEAK = f"greatest(1e0, {q.peak()} / p)"
register(
    "a2_range_scale", on(fx.px, lambda d: sample_columns(metrics.range_scale(d))),
    q.query(f"SELECT texture_id, y, x, {q.rounded(**rgb(lambda c: f'{c} / p / {SCALED_PEAK}'), a=q.clamp01('a'))}"
            " FROM px JOIN peaks USING (texture_id)", "px", ctes=[PEAKS]),
)
SECOND = ("texture_id", "y", "x", "r2", "g2", "b2", "a2")
register(
    "a3_range_scale_by", on(fx.px_pair, lambda d: metrics.range_scale_pairs(d).select(*SECOND)),
    q.query(f"SELECT texture_id, y, x, {q.rounded(r2='r2 * p', g2='g2 * p', b2='b2 * p', a2='a2')}"
            " FROM px_pair JOIN peaks USING (texture_id)", "px_pair", ctes=[PEAKS]),
)


def square(c: str) -> str:
    return f"({c} - {c}2) * ({c} - {c}2)"


SQ_RGB = f"({square('r')} + {square('g')} + {square('b')}) / 3"


def tone(exposure: float) -> str:
    def curve(c: str) -> str:
        return f"({exposure}e0 * greatest(0e0, {c}) / (1 + {exposure}e0 * greatest(0e0, {c})))"

    terms = " + ".join(f"pow({curve(c)} - {curve(c + '2')}, 2)" for c in "rgb")
    return f"sqrt(avg(({terms}) / 3))"


def unit(c: str, suffix: str) -> str:
    length = "sqrt(" + " + ".join(f"pow(2 * {k}{suffix} - 1, 2)" for k in "rgb") + ")"
    return f"(CASE WHEN {length} > 0 THEN (2 * {c}{suffix} - 1) / {length} ELSE {1 if c == 'b' else 0}e0 END)"


DOT = " + ".join(f"{unit(c, '')} * {unit(c, '2')}" for c in "rgb")
ANGLE = f"sqrt(avg(pow(acos(greatest(-1e0, least(1e0, {DOT}))), 2)))"


def report_sql(source: str, rgb_square: str = SQ_RGB, normals: bool = False) -> str:
    angle = f", {ANGLE} AS ang" if normals else ""
    return f"""
        SELECT texture_id, {q.r6('e')} AS rmse, {q.r6('e * e')} AS mse,
               {q.r6('CASE WHEN e > 0 THEN 20 * log10(1 / nullif(e, 0)) END')} AS psnr, e = 0 AS identical,
               {q.r6('ea')} AS rmse_alpha, {q.r6('t0')} AS tone_0, {q.r6('t1')} AS tone_1, {q.r6('t2')} AS tone_2,
               {q.r6('(t0 + t1 + t2) / 3')} AS tone_mean{', ' + q.r6('ang') + ' AS angular_error' if normals else ''}
        FROM (SELECT texture_id, sqrt(avg({rgb_square})) AS e, sqrt(avg({square('a')})) AS ea,
                     {tone(2.2)} AS t0, {tone(1.0)} AS t1, {tone(0.22)} AS t2{angle} FROM {source} GROUP BY 1)"""


def rgb_report_sql(weight: str = "1") -> str:
    return q.query(f"""
        SELECT texture_id, {q.r6('e')} AS rmse, {q.r6('e * e')} AS mse,
               {q.r6('CASE WHEN e > 0 THEN 20 * log10(1 / nullif(e, 0)) END')} AS psnr, e = 0 AS identical
        FROM (SELECT texture_id, sqrt(avg({weight} * ({SQ_RGB}))) AS e FROM px_pair GROUP BY 1)""", "px_pair")


def paired(spark: SparkSession, folder: str) -> DataFrame:
    return pairs.pair(fx.px(spark, folder), fx.px_low(spark, folder))


register("a4_diff_rgb", on(fx.px_pair, metrics.diff_rgb), rgb_report_sql())
register("a5_diff_alpha", on(fx.px_pair, metrics.diff_alpha), q.query(f"SELECT texture_id, {q.r6('sqrt(avg(' + square('a') + '))')} AS rmse_alpha FROM px_pair GROUP BY 1", "px_pair"))
register("a6_diff_rgb_weighted", on(fx.px_pair, lambda d: metrics.diff_rgb(d, weighted=True)), rgb_report_sql("a"))
register(
    "a7_diff_tonemapped", on(fx.px_pair, metrics.diff_tonemapped),
    q.query(f"SELECT texture_id, {q.r6('t0')} AS tone_0, {q.r6('t1')} AS tone_1, {q.r6('t2')} AS tone_2, {q.r6('(t0 + t1 + t2) / 3')} AS tone_mean"
            f" FROM (SELECT texture_id, {tone(2.2)} AS t0, {tone(1.0)} AS t1, {tone(0.22)} AS t2 FROM px_pair GROUP BY 1)", "px_pair"),
)
register("a8_diff_angular", on(fx.px_pair, metrics.diff_angular), q.query(f"SELECT texture_id, {q.r6(ANGLE)} AS angular_error FROM px_pair GROUP BY 1", "px_pair"))
register(
    "a9_diff_report", lambda s, d: compare.compare_images(fx.px(s, d), fx.px_low(s, d), normals=True).drop("code"),
    q.query(report_sql("px_pair", normals=True), "px_pair"),
)


def _partly_absent(spark: SparkSession, folder: str) -> DataFrame:
    """The coarse images, of which some are absent, cropped, or lack a sample."""
    fifth = F.col("texture_id") % 5
    corner = (F.col("x") == 0) & (F.col("y") == 0)
    return fx.px_low(spark, folder).filter((fifth != 1) & ((fifth != 2) | ~corner) & ((fifth != 3) | (F.col("y") < 2)))


KEPT = ("kept", """
    SELECT *, CASE texture_id % 5 WHEN 1 THEN false WHEN 2 THEN NOT (x = 0 AND y = 0) WHEN 3 THEN y < 2 ELSE true END AS keep FROM px_pair""")
CODES = ("codes", """
    SELECT texture_id, CASE WHEN count(*) FILTER (keep) = 0 THEN 'missing_other'
        WHEN max(y) FILTER (keep) <> max(y) OR max(x) FILTER (keep) <> max(x) THEN 'size'
        WHEN count(*) FILTER (keep) < count(*) THEN 'samples' END AS code FROM kept GROUP BY 1""")
REPORT_VALUES = ("rmse", "mse", "psnr", "identical", "rmse_alpha", "tone_0", "tone_1", "tone_2", "tone_mean")
register(
    "a9_compare_sizes", lambda s, d: compare.compare_images(fx.px(s, d), _partly_absent(s, d)),
    q.query("SELECT texture_id, code, " + ", ".join(f"CASE WHEN code IS NULL THEN {c} END AS {c}" for c in REPORT_VALUES)
            + " FROM report JOIN codes USING (texture_id)", "px_pair", ctes=[KEPT, CODES, ("report", report_sql("px_pair"))]),
)


def _named_pairs(spark: SparkSession, folder: str) -> DataFrame:
    named = fx.files(spark, folder).select(F.col("doc_id").alias("texture_id"), "name")
    return compare.compare_pairs(fx.px_pair(spark, folder).join(named, "texture_id"), F.col("name"))


DECODE = "pow(greatest(0e0, {0}2 * (a2 * 0.85e0 + 0.15e0)), 2.2e0)"
NAMED = [
    PEAKS,
    ("t1", "SELECT p.texture_id, y, x, r, g, b, a, name, "
           + ", ".join(f"CASE WHEN name LIKE '%rgbm%' THEN {DECODE.format(c)} ELSE {c}2 END AS {c}2" for c in "rgb")
           + ", CASE WHEN name LIKE '%rgbm%' THEN a ELSE a2 END AS a2 FROM px_pair p JOIN files f ON f.doc_id = p.texture_id"),
    ("t2", "SELECT texture_id, y, x, r, g, b, a, name, CASE WHEN name LIKE '%bc3n%' THEN a2 ELSE r2 END AS r2, g2,"
           " CASE WHEN name LIKE '%bc3n%' THEN b ELSE b2 END AS b2,"
           " CASE WHEN name LIKE '%bc3n%' OR name LIKE '%bc6%' THEN a ELSE a2 END AS a2 FROM t1"),
    ("t3", "SELECT t2.* EXCLUDE (r2, g2, b2), "
           + ", ".join(f"{c}2 * CASE WHEN name LIKE '%rgbm%' THEN p ELSE 1e0 END AS {c}2" for c in "rgb")
           + " FROM t2 JOIN peaks USING (texture_id)"),
]
SCALED_PAIR = ("sc2", "SELECT texture_id, y, x, r, g, b, a, r2 * p AS r2, g2 * p AS g2, b2 * p AS b2, a2 FROM px_pair JOIN peaks USING (texture_id)")
register(
    "a9_compare_scaled", lambda s, d: compare.compare_images(fx.px(s, d), fx.px_low(s, d), rangescale=True).drop("code"),
    q.query(report_sql("sc2"), "px_pair", ctes=[PEAKS, SCALED_PAIR]),
)


def _stored_pair(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The images and their coarse versions, as bucketed tables."""
    tables_ = []
    for df in (fx.px(spark, folder), fx.px_low(spark, folder)):
        name = "samples_" + uuid.uuid4().hex
        tables.store_samples(df, name, int(spark.conf.get("spark.sql.shuffle.partitions")), f"{shared_folder(spark)}/{name}")
        tables_.append(tables.stored_samples(spark, name))
    return tables_[0], tables_[1]


register(
    "a9_compare_stored", lambda s, d: compare.compare_images(*_stored_pair(s, d), normals=True).drop("code"),
    q.query(report_sql("px_pair", normals=True), "px_pair"),
)
register("a9_compare_by_name", _named_pairs, q.query(report_sql("t3"), "px_pair", "files", ctes=NAMED))
HIST_BIN = "CAST(floor(least(1535, floor(" + q.clamp01("pow(greatest(0e0, {0} / 2.2e0), 1 / 2.2e0)") + " * 1536)) / 3) AS INT)"
register(
    "a10_histogram", on(fx.px, metrics.histogram),
    q.query(f"""
        SELECT texture_id, channel, bin, {q.r6('coalesce(n, 0) / 3')} AS value
        FROM (SELECT DISTINCT texture_id, channel, CAST(unnest(range(0, 512)) AS INT) AS bin FROM s)
        LEFT JOIN (SELECT texture_id, channel, bin, count(*) AS n FROM s GROUP BY ALL) USING (texture_id, channel, bin)""",
        "px", ctes=[("s", " UNION ALL ".join(f"SELECT texture_id, '{c}' AS channel, {HIST_BIN.format(c)} AS bin FROM px" for c in "rgb"))]),
)
register(
    "a10_histogram_uneven", on(fx.px, lambda d: metrics.histogram(d, bins=100, reduce=3)),
    q.query(f"""
        SELECT texture_id, channel, bin, {q.r6("coalesce(n, 0) / least(3, 100 - bin * 3)")} AS value
        FROM (SELECT * FROM (SELECT DISTINCT texture_id FROM px), (SELECT unnest(['r', 'g', 'b']) AS channel), (SELECT CAST(unnest(range(0, 34)) AS INT) AS bin))
        LEFT JOIN (SELECT texture_id, channel, CAST(floor(least(99, floor({q.clamp01("pow(greatest(0e0, v / 2.2e0), 1 / 2.2e0)")} * 100)) / 3) AS INT) AS bin, count(*) AS n
                   FROM (SELECT texture_id, unnest(['r', 'g', 'b']) AS channel, unnest([r, g, b]) AS v FROM px) GROUP BY 1, 2, 3)
        USING (texture_id, channel, bin)""", "px"),
)
register(
    "a11_diff_channel_weighted", on(fx.px_pair, lambda d: metrics.diff_channel_weighted(d, (1.0, 2.0, 0.0, 0.5))),
    q.query(f"SELECT texture_id, {q.r6('sqrt(avg((' + square('r') + ' + 2 * ' + square('g') + ' + 0.5e0 * ' + square('a') + ') / 3.5e0))')}"
            " AS rmse_weighted FROM px_pair GROUP BY 1", "px_pair"),
)
register(
    "a12_tile_stats", on(fx.px, lambda d: tiles.tile_stats(d, 5, 4)),
    q.query("SELECT texture_id, CAST(y // 4 AS INT) AS by, CAST(x // 5 AS INT) AS bx, count(*) AS n_samples, "
            + q.rounded(**{f"{f}_{c}": f"{f}({c})" for c in "rgba" for f in ("min", "max", "avg")}) + " FROM px GROUP BY 1, 2, 3", "px"),
)
BLOCKS = ("blocks", """
    SELECT *, CASE WHEN hi = lo THEN 0 ELSE CAST(floor((h - lo) / nullif(hi - lo, 0) * 7 + 0.5e0) AS INT) END AS i
    FROM hm JOIN (SELECT texture_id, y // 4 AS by, x // 4 AS bx, min(h) AS lo, max(h) AS hi FROM hm GROUP BY ALL) t
      ON t.texture_id = hm.texture_id AND t.by = hm.y // 4 AND t.bx = hm.x // 4""")
register(
    "a13_block_quantize",
    on(fx.hm, lambda d: tiles.block_quantize(d, ("h",)).select("texture_id", "y", "x", "h_index", "h_q")),
    q.query(f"SELECT texture_id, y, x, i AS h_index, {q.r6('lo + i * (hi - lo) / 7')} AS h_q FROM blocks", "hm", ctes=[BLOCKS]),
)
register(
    "a13_block_quantize_error", on(fx.hm, lambda d: tiles.block_quantize_error(d, ("h",))),
    q.query(f"SELECT texture_id, {q.r6('sqrt(avg(pow(h - (lo + i * (hi - lo) / 7), 2)))')} AS rmse_h FROM blocks GROUP BY 1", "hm", ctes=[BLOCKS]),
)
FORMATS = ("fmt", "SELECT * FROM (VALUES ('bc1', 4, 4, 8), ('bc7', 4, 4, 16), ('astc_ldr_6x5', 6, 5, 16), ('bc4', 4, 4, 8)) v(format, bw, bh, bb)")
register(
    "a14_size_estimate", on(fx.textures, formats.size_estimate),
    q.query("""
        SELECT texture_id, format, count(*) AS n_mips,
               CAST(sum(CAST(ceil(mip_width / bw) * ceil(mip_height / bh) AS BIGINT) * depth * bb) AS BIGINT) AS total_bytes
        FROM plan JOIN fmt USING (format) GROUP BY 1, 2""", "textures", ctes=[PLAN_SQL, FORMATS]),
)
register(
    "a15_raw_size_check",
    on(fx.textures, lambda d: file_source.raw_size_check(
        d.withColumn("n_bytes", F.col("width").cast("bigint") * F.col("height") * F.when(F.col("format") == "bc4", 3).otherwise(4))
    ).select("texture_id", "n_bytes", "expected_bytes")),
    q.query("""
        SELECT texture_id, CAST(width AS BIGINT) * height * 3 AS n_bytes, CAST(width AS BIGINT) * height * 4 AS expected_bytes
        FROM textures WHERE format = 'bc4'""", "textures"),
)

# --- joins ---------------------------------------------------------------------------------------

PAIR_VALUES = {c + n: c + n for c in "rgba" for n in ("", "2")}
register("j1_pair", paired, q.query(f"SELECT texture_id, y, x, {q.rounded(**PAIR_VALUES)} FROM px_pair", "px_pair"))
register(
    "j2_pair_errors",
    lambda s, d: pairs.pair_errors(
        fx.textures(s, d),
        fx.textures(s, d).withColumns({
            "width": F.when(F.col("format") == "bc1", F.col("width") + 1).otherwise(F.col("width")),
            "height": F.when(F.col("width") > 500, F.col("height") * 2).otherwise(F.col("height")),
        }),
    ),
    q.query("""
        SELECT * FROM (SELECT texture_id, width, height, CASE WHEN format = 'bc1' THEN width + 1 ELSE width END AS width2,
                   CASE WHEN width > 500 THEN height * 2 ELSE height END AS height2,
                   CASE WHEN format = 'bc1' THEN 'width' WHEN width > 500 THEN 'height' END AS code FROM textures)
        WHERE code IS NOT NULL""", "textures"),
)
register(
    "j3_diff_image", lambda s, d: pairs.diff_image(paired(s, d)),
    q.query(f"SELECT texture_id, y, x, {q.rounded(**{c: f'abs({c} - {c}2)' for c in 'rgba'})} FROM px_pair", "px_pair"),
)
INSIDE = ("inside", """
    SELECT p.*, layer_files, face_files, mip_files, first_width, first_format, first_alpha_mode
    FROM parts_gaps p JOIN extents USING (base) WHERE layer < layer_files AND face < face_files AND mip < mip_files""")
MISSING = ("missing", """
    SELECT base, layer_file, face_file, mip_file FROM (
      SELECT base, layer_file, face_file, CAST(unnest(range(0, mip_files)) AS BIGINT) AS mip_file FROM (
        SELECT base, layer_file, mip_files, CAST(unnest(range(0, face_files)) AS BIGINT) AS face_file FROM (
          SELECT base, face_files, mip_files, CAST(unnest(range(0, layer_files)) AS BIGINT) AS layer_file FROM extents))) g
    WHERE NOT EXISTS (SELECT 1 FROM parts_gaps p WHERE p.base = g.base AND p.layer = layer_file AND p.face = face_file AND p.mip = mip_file)""")
register(
    "j4_stitch_missing", on(fx.file_parts, stitch.stitch_missing),
    q.query("SELECT base, layer_file, face_file, mip_file FROM missing", "parts_gaps", "extents", ctes=[MISSING]),
)


def _both_names(spark: SparkSession, folder: str) -> DataFrame:
    """Every file under its own name and, where that has an M, also without it."""
    named = fx.parts(spark, folder).select("file")
    return named.unionByName(
        named.filter(F.col("file").contains("_M")).select(F.regexp_replace("file", "_M", "_").alias("file"))
    )


PLACES = ("base", "layer_file", "face_file", "mip_file")
register(
    "j5_resolve_part_names", lambda s, d: stitch.resolve_part_names(stitch.parse_parts(_both_names(s, d))).select(*PLACES, "file", "priority"),
    q.query("""
        SELECT base, CAST(layer AS BIGINT) AS layer_file, CAST(face AS BIGINT) AS face_file, CAST(mip AS BIGINT) AS mip_file, file,
               CASE WHEN contains(file, '_M') THEN 1 ELSE 2 END AS priority FROM parts""", "parts"),
)
register(
    "j6_format_lookup",
    on(fx.textures, lambda d: formats.with_format(d).select("texture_id", "format", "block_w", "block_h", "block_bytes")),
    q.query("SELECT texture_id, format, bw AS block_w, bh AS block_h, bb AS block_bytes FROM textures JOIN fmt USING (format)", "textures", ctes=[FORMATS]),
)



def _odd_formats(spark: SparkSession, folder: str) -> DataFrame:
    """Textures, a quarter of them in a format that isn't known and some in none."""
    odd = F.when(F.col("format") == "bc4", "etc2").when(F.col("texture_id") % 10 == 0, F.lit(None)).otherwise(F.col("format"))
    return fx.textures(spark, folder).withColumns({"format": odd, "n_layers": F.lit(2), "n_faces": (F.col("texture_id") % 6 + 1).cast("int")})


ODD_FORMATS = ("odd", """
    SELECT * REPLACE (CASE WHEN format = 'bc4' THEN 'etc2' WHEN texture_id % 10 = 0 THEN NULL ELSE format END AS format),
           CAST(texture_id % 6 + 1 AS INT) AS n_faces FROM textures""")
register(
    "j6_unknown_formats", lambda s, d: formats.unknown_formats(_odd_formats(s, d)).select("texture_id", "format"),
    q.query("SELECT texture_id, format FROM odd WHERE format IS NULL OR format = 'etc2'", "textures", ctes=[ODD_FORMATS]),
)
register(
    "a14_size_layers_faces", lambda s, d: formats.size_estimate(_odd_formats(s, d)),
    q.query("""
        SELECT o.texture_id, o.format, count(*) AS n_mips,
               CAST(sum(CAST(ceil(mip_width / bw) * ceil(mip_height / bh) AS BIGINT) * p.depth * bb * 2 * n_faces) AS BIGINT) AS total_bytes
        FROM plan p JOIN odd o USING (texture_id) LEFT JOIN fmt ON o.format = fmt.format GROUP BY 1, 2""",
            "textures", ctes=[PLAN_SQL, FORMATS, ODD_FORMATS]),
)

# --- detach and stitch ------------------------------------------------------------------------------

SUB = ("file", "layer_file", "face_file", "mip_file", "layer", "face", "mip", "n_layers", "n_faces", "n_mips", "mip0_width", "mip0_height")
register(
    "r1_detach_mips", on(fx.whole, lambda d: detach.detach(d).select(*SUB)),
    q.query("""
        SELECT concat(texture_id, '_M', mip, '.dds') AS file, 0 AS layer_file, 0 AS face_file, mip AS mip_file, layer, face,
               0 AS mip, 2 AS n_layers, 4 AS n_faces, 1 AS n_mips, 64 >> mip AS mip0_width, 64 >> mip AS mip0_height FROM parts""", "parts"),
)
register(
    "r1_detach_layers_faces", on(fx.whole, lambda d: detach.detach(d, ("layer", "face")).select(*SUB)),
    q.query("""
        SELECT concat(texture_id, '_L', layer, '_F', face, '.dds') AS file, layer AS layer_file, face AS face_file, 0 AS mip_file,
               0 AS layer, 0 AS face, mip, 1 AS n_layers, 1 AS n_faces, 3 AS n_mips, 64 AS mip0_width, 64 AS mip0_height FROM parts""", "parts"),
)
register(
    "r2_detach_name",
    on(fx.whole, lambda d: d.select("texture_id", "layer", "face", "mip", *[
        detach.detach_name(F.col("texture_id").cast("string"), axes).alias(n)
        for n, axes in (("all_axes", ("mip", "face", "layer")), ("faces", ("face",)), ("default_axis", ()))
    ])),
    q.query("""
        SELECT texture_id, layer, face, mip, concat(texture_id, '_L', layer, '_F', face, '_M', mip, '.dds') AS all_axes,
               concat(texture_id, '_F', face, '.dds') AS faces, concat(texture_id, '_M', mip, '.dds') AS default_axis FROM parts""", "parts"),
)
register(
    "r3_detach_meta",
    on(fx.textures, lambda d: detach.detach_meta(d.withColumn("cube_flags", F.lit(64512)), ("face",)).unionByName(
        detach.detach_meta(d.withColumn("cube_flags", F.lit(64512)), ("mip",))).select("texture_id", "format", "cube_flags")),
    q.query("SELECT texture_id, format, unnest([0, 64512]) AS cube_flags FROM textures", "textures"),
)
register(
    "r4_parse_parts", on(fx.parts, lambda d: stitch.parse_parts(d.select("file"))),
    q.query("""
        SELECT file, base, CAST(layer AS BIGINT) AS layer_file, CAST(face AS BIGINT) AS face_file, CAST(mip AS BIGINT) AS mip_file,
               CASE WHEN contains(file, '_M') THEN 1 ELSE 2 END AS priority FROM parts""", "parts"),
)
register(
    "r5_stitch_extent", on(fx.file_parts, stitch.stitch_extent),
    q.query("SELECT base, CAST(layer_files AS BIGINT) AS layer_files, CAST(face_files AS BIGINT) AS face_files, CAST(mip_files AS BIGINT) AS mip_files FROM extents", "parts_gaps", "extents"),
)
register(
    "r6_stitch", on(fx.file_parts, lambda d: stitch.stitch(d).select("base", "file", "layer", "face", "mip")),
    q.query("""SELECT base, file, CAST(layer AS BIGINT) AS layer, CAST(face AS BIGINT) AS face, CAST(mip AS BIGINT) AS mip
            FROM inside""", "parts_gaps", "extents", ctes=[INSIDE]),
)
CHECKED = ("checked", """
    SELECT *, greatest(1, first_width >> mip) AS want FROM inside WHERE NOT (layer = 0 AND face = 0 AND mip = 0)""")
ERRORS = ("errors", """
    SELECT *, 'size' AS code, concat(width, 'x', width, 'x1') AS detail FROM checked WHERE width <> want
    UNION ALL SELECT *, 'format', format FROM checked WHERE format <> first_format
    UNION ALL SELECT *, 'alpha_mode', alpha_mode FROM checked WHERE alpha_mode <> first_alpha_mode""")
register(
    "r7_stitch_errors", on(fx.file_parts, stitch.stitch_errors),
    q.query("SELECT base, file, CAST(layer AS BIGINT) AS layer_file, CAST(face AS BIGINT) AS face_file, CAST(mip AS BIGINT) AS mip_file, code, detail FROM errors",
            "parts_gaps", "extents", ctes=[INSIDE, CHECKED, ERRORS]),
)
register(
    "r7_stitch_clean", on(fx.file_parts, lambda d: stitch.stitch_clean(d).select("base", "file", "layer", "face", "mip")),
    q.query("""SELECT base, file, CAST(layer AS BIGINT) AS layer, CAST(face AS BIGINT) AS face, CAST(mip AS BIGINT) AS mip
               FROM inside WHERE base NOT IN (SELECT base FROM errors) AND base NOT IN (SELECT base FROM missing)""",
            "parts_gaps", "extents", ctes=[INSIDE, CHECKED, ERRORS, MISSING]),
)
register(
    "r8_stitch_limits", on(fx.file_parts, lambda d: stitch.stitch_limits(d.withColumn("n_faces", F.when(F.col("format") == "bc1", 1).otherwise(2)))),
    q.query("""
        SELECT base, 'too_many_faces' AS code, CAST(2 * face_files AS BIGINT) AS total FROM extents
        WHERE first_format <> 'bc1' AND 2 * face_files > 6""", "parts", "extents"),
)
register(
    "r9_cube_flags",
    on(fx.file_parts, lambda d: stitch.stitch_extent(d).select(
        "base", stitch.cube_flags(F.col("face_files"), 1024).alias("flags"),
        stitch.cube_flags(F.col("face_files"), 1024, strict=True).alias("flags_strict"))),
    q.query("""
        SELECT base, CASE WHEN face_files = 1 THEN 0 ELSE CAST(1024 * (pow(2, face_files) - 1) AS INT) END AS flags,
               CAST(1024 * (pow(2, face_files) - 1) AS INT) AS flags_strict FROM extents""", "parts", "extents"),
)
register(
    "r10_stitch_empty",
    lambda s, d: stitch.stitch_empty(
        fx.parts(s, d).select(F.concat(F.lit("t"), F.col("texture_id").cast("string")).alias("base")), fx.file_parts(s, d)),
    q.query("SELECT DISTINCT base FROM parts WHERE base NOT IN (SELECT base FROM extents)", "parts", "extents"),
)
register(
    "r11_union_levels",
    on(fx.px, lambda d: sample_columns(d.withColumn("mip", F.lit(0))).unionByName(
        sample_columns(resample.next_mip(d.withColumn("mip", F.lit(0)))))),
    q.query(f"SELECT texture_id, 0 AS mip, y, x, {q.rounded(**{c: c for c in 'rgba'})} FROM px UNION ALL"
            f" SELECT texture_id, 1 AS mip, y, x, {q.rounded(**{c: c for c in 'rgba'})} FROM half", "px",
            ctes=q.resize_ctes("half", "px", "box")),
)

# --- batching and order --------------------------------------------------------------------------------

BATCHES = [
    ("ordered", "SELECT *, row_number() OVER (PARTITION BY dir ORDER BY doc_id) AS i FROM files"),
    ("walk", """
        SELECT doc_id, dir, n_bytes, i, n_bytes AS used, 1 AS n, 0 AS batch_id FROM ordered WHERE i = 1
        UNION ALL
        SELECT o.doc_id, o.dir, o.n_bytes, o.i,
               CASE WHEN used + o.n_bytes > 20000 OR n >= 50 THEN o.n_bytes ELSE used + o.n_bytes END,
               CASE WHEN used + o.n_bytes > 20000 OR n >= 50 THEN 1 ELSE n + 1 END,
               CASE WHEN used + o.n_bytes > 20000 OR n >= 50 THEN batch_id + 1 ELSE batch_id END
        FROM walk w JOIN ordered o ON o.dir = w.dir AND o.i = w.i + 1"""),
]


def batched(spark: SparkSession, folder: str) -> DataFrame:
    return batches.assign_batches(fx.files(spark, folder), 20_000, 50, order=("doc_id",))


register(
    "b1_assign_batches", lambda s, d: batched(s, d).select("doc_id", "dir", "batch_id"),
    q.query("SELECT doc_id, dir, CAST(batch_id AS BIGINT) AS batch_id FROM walk", "files", ctes=BATCHES, recursive=True),
)


def _loose_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files of which some have no folder, and some no size."""
    doc = F.col("doc_id")
    return fx.files(spark, folder).withColumns({"dir": F.when(doc % 4 > 0, F.col("dir")), "n_bytes": F.when(doc % 7 > 0, F.col("n_bytes"))})


LOOSE = [
    ("loose", "SELECT doc_id, CASE WHEN doc_id % 4 > 0 THEN dir END AS dir, CASE WHEN doc_id % 7 > 0 THEN n_bytes ELSE 0 END AS n_bytes FROM files"),
    (BATCHES[0][0], BATCHES[0][1].replace("FROM files", "FROM loose")),
    (BATCHES[1][0], BATCHES[1][1].replace("o.dir = w.dir", "o.dir IS NOT DISTINCT FROM w.dir")),
]
register(
    "b1_null_folders",
    lambda s, d: batches.assign_batches(_loose_files(s, d), 20_000, 50, order=("doc_id",)).select("doc_id", "dir", "batch_id"),
    q.query("SELECT doc_id, dir, CAST(batch_id AS BIGINT) AS batch_id FROM walk", "files", ctes=LOOSE, recursive=True),
)
register(
    "b2_batch_report", lambda s, d: batches.batch_report(batched(s, d)),
    q.query("""SELECT dir, CAST(batch_id AS BIGINT) AS batch_id, count(*) AS n_files, CAST(sum(n_bytes) AS BIGINT) AS total_bytes
            FROM walk GROUP BY 1, 2""", "files", ctes=BATCHES, recursive=True),
)
register(
    "b3_ordered_subresources", on(fx.whole, lambda d: detach.ordered_subresources(d).select("texture_id", "layer", "face", "mip")),
    q.query("SELECT texture_id, layer, face, mip FROM parts ORDER BY ALL", "parts"),
)
register(
    "b4_limit_levels", on(fx.whole, lambda d: samples.limit_levels(d, 2).select("texture_id", "layer", "face", "mip")),
    q.query("SELECT texture_id, layer, face, mip FROM parts WHERE mip < 2", "parts"),
)

# --- format dimension, extension points, whole conversions ------------------------------------------------

register(
    "l1_format_dimension",
    on(fx.textures, lambda d: formats.with_format(d).groupBy("format", "family", "pixel_type", "dds10").agg(F.count("*").alias("n_textures"))),
    q.query("""
        SELECT format, CASE WHEN format LIKE 'astc%' THEN 'astc' ELSE 'bc' END AS family, 'unsigned_norm' AS pixel_type,
               format LIKE 'astc%' OR format = 'bc7' AS dds10, count(*) AS n_textures FROM textures GROUP BY 1""", "textures"),
)
register(
    "u1_map_samples", on(fx.px, lambda d: samples.map_samples(d, {"r": F.col("g") * F.col("x"), "a": F.lit(1.0) - F.col("a")})),
    sample_sql("px", r="g * x", a="1 - a"),
)


def _sql_functions(spark: SparkSession, folder: str) -> DataFrame:
    register_functions(spark)
    return fx.px(spark, folder).selectExpr(
        "texture_id", "y", "x", "tf_srgb_encode(r) AS r", "tf_slope(g, b) AS g", "tf_unorm(b, 4) AS b", "tf_binary_alpha(a, 127) AS a"
    )


register(
    "u2_sql_functions", _sql_functions,
    sample_sql("px", r=q.linear_to_srgb(q.clamp01("r")), g="CASE WHEN b = 0 THEN g ELSE 0.5e0 * ((2 * g - 1) / b) + 0.5e0 END",
               b=q.unorm("b", 4), a=f"CASE WHEN floor({q.clamp01('a')} * 255 + 0.5e0) > 127 THEN 1e0 ELSE 0e0 END"),
)


def _table_functions(spark: SparkSession, folder: str) -> DataFrame:
    """Every level of every texture, with its share of the texture's bytes, in SQL."""
    register_table_functions(spark)
    fx.textures(spark, folder).createOrReplaceTempView("u2_textures")
    return spark.sql("""
        SELECT texture_id, format, mip, mip_width, mip_height, n_mips, total_bytes
        FROM u2_textures, LATERAL tf_mip_plan(width, height, 32, 1), LATERAL tf_size_estimate(width, height, format)""")


register(
    "u2_table_functions", _table_functions,
    q.query("""
        SELECT texture_id, format, mip, mip_width, mip_height,
               CAST(count(*) OVER (PARTITION BY texture_id) AS INT) AS n_mips,
               CAST(sum(CAST(ceil(mip_width / bw) * ceil(mip_height / bh) AS BIGINT) * bb) OVER (PARTITION BY texture_id) AS BIGINT) AS total_bytes
        FROM plan JOIN fmt USING (format)""", "textures", ctes=[PLAN_SQL, FORMATS]),
)

def _rgbm_ctes(source: str = "px") -> list[tuple[str, str]]:
    """Range scaling and sRGB (en), then RGBM (co)."""
    scaled = ("sc", f"SELECT texture_id, y, x, {', '.join(f'{c} / p / {SCALED_PEAK} AS {c}' for c in 'rgb')}, {q.clamp01('a')} AS a"
                    f" FROM {source} JOIN peaks USING (texture_id)")
    encoded = ("en", f"SELECT texture_id, y, x, {', '.join(f'{to_s(c)} AS {c}' for c in 'rgb')}, a FROM sc")
    coded = ("co", f"SELECT texture_id, y, x, {', '.join(q.clamp01(f'{c} / {M}') + f' AS {c}' for c in 'rgb')}, ({M} - 0.15e0) / 0.85e0 AS a FROM en")
    return [PEAKS, scaled, encoded, coded]


def _convert_sql() -> str:
    """RGBM conversion: range scaling, sRGB, RGBM, then a gamma-correct box pyramid at 8 bits."""
    start = ("start", f"SELECT texture_id, y, x, {', '.join(f'{to_lin(c)} AS {c}' for c in 'rgb')}, a FROM co")
    ctes, names = q.chain_ctes("lv", "start", "box", 4)
    first = f"SELECT texture_id, 0 AS mip, y, x, {q.rounded(**{c: q.unorm(c, 8) for c in 'rgba'})} FROM co"
    rest = [
        f"SELECT texture_id, {k} AS mip, y, x, {q.rounded(**{c: q.unorm(to_s(c), 8) for c in 'rgb'}, a=q.unorm('a', 8))} FROM {n}"
        for k, n in enumerate(names, 1)
    ]
    return q.query(" UNION ALL ".join([first, *rest]), "px", ctes=[*_rgbm_ctes(), start, *ctes])


register(
    "x1_convert_rgbm", on(fx.px, lambda d: sample_columns(convert.convert(d, rgbm=True, rangescale=True))), _convert_sql(),
)


def _quantized_formats(spark: SparkSession, folder: str) -> DataFrame:
    out = None
    for name in ("bc1a", "bc2", "bc5s"):
        one = convert.quantize_for_format(fx.px(spark, folder), name, alpha_dithering=name == "bc2")
        one = one.withColumn("format", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


register(
    "x2_quantize_for_format",
    _quantized_formats,
    q.query(" UNION ALL ".join(
        f"SELECT '{name}' AS format, texture_id, y, x, {q.rounded(**values)} FROM px" for name, values in (
            ("bc1a", {**{c: q.unorm(c, 8) for c in "rgb"}, "a": f"CASE WHEN floor({q.clamp01('a')} * 255 + 0.5e0) > 127 THEN 1e0 ELSE 0e0 END"}),
            ("bc2", {**{c: q.unorm(c, 8) for c in "rgb"}, "a": f"floor({q.clamp01('a')} * 15 + {DITHER}) / 15"}),
            ("bc5s", {c: f"floor(least(1e0, greatest(-1e0, {c})) * 127 + 0.5e0) / 127" for c in "rgba"}),
        )), "px"),
)
register(
    "x3_convert_stored", lambda s, d: sample_columns(convert.convert(samples.scale_bias(stored_textures(s, d), "a", *ODD_ALPHA))),
    _from_source_sql("px_odd", stored=lambda c: q.unorm(c, 8)),
)
register(
    "x4_convert_lumi", lambda s, d: sample_columns(convert.convert(stored_textures(s, d), "lumi")),
    _from_source_sql(stored=lambda c: None if c in "gba" else q.unorm(c, 8)),
)
FLAWS = "format = 'nonsense' OR coalesce(alpha_bits, 1) > 8"


def _mixed_sql() -> str:
    """Plain textures from their stored levels, RGBM ones from level 0, each value as its own format stores it."""
    ways = [
        PX_ODD,
        ("plain", f"SELECT px_odd.* FROM px_odd JOIN px_textures USING (texture_id) WHERE NOT rgbm AND NOT ({FLAWS})"),
        ("hdr", f"SELECT px_odd.* FROM px_odd JOIN px_textures USING (texture_id) WHERE rgbm AND NOT ({FLAWS})"),
    ]
    ctes, levels = _from_source_levels("plain")
    start = ("rstart", "SELECT texture_id, y, x, " + ", ".join(f"{to_lin(c)} AS {c}" for c in "rgb") + ", a FROM rg")
    either = ("rg", "SELECT * FROM en WHERE texture_id % 10 = 6 UNION ALL SELECT * FROM co WHERE texture_id % 10 <> 6")
    more, names = q.chain_ctes("rl", "rstart", "box", 4)
    levels += [(0, "rg", lambda c: c), *((k, n, to_s) for k, n in enumerate(names, 1))]
    every = " UNION ALL ".join(
        f"SELECT texture_id, {mip} AS mip, y, x, {', '.join(f'{back(c)} AS {c}' for c in 'rgb')}, a FROM {name}" for mip, name, back in levels
    )

    def colour(c: str) -> str:
        signed = f"floor(least(1e0, greatest(-1e0, {c})) * 127 + 0.5e0) / 127"
        lumi = f"WHEN format = 'lumi' AND '{c}' <> 'r' THEN NULL "
        return f"CASE WHEN format = 'bc6' THEN {c} WHEN format = 'bc5s' THEN {signed} {lumi}ELSE {q.unorm(c, 8)} END"

    bits = ("CASE WHEN NOT dither THEN 0 WHEN format = 'bc1a' THEN 1 WHEN format = 'bc2' THEN coalesce(alpha_bits, 4)"
            " WHEN coalesce(alpha, FALSE) THEN coalesce(alpha_bits, 8) ELSE 0 END")
    alpha = (f"CASE WHEN format = 'bc6' THEN a WHEN format = 'bc5s' THEN floor(least(1e0, greatest(-1e0, a)) * 127 + 0.5e0) / 127"
             f" WHEN format = 'lumi' THEN NULL WHEN bits > 0 THEN floor({q.clamp01('a')} * (pow(2e0, bits) - 1) + {DITHER}) / nullif(pow(2e0, bits) - 1, 0)"
             f" WHEN format = 'bc1a' THEN CASE WHEN floor({q.clamp01('a')} * 255 + 0.5e0) > 127 THEN 1e0 ELSE 0e0 END ELSE {q.unorm('a', 8)} END")
    body = (f"SELECT texture_id, 0 AS face, mip, y, x, {q.rounded(**{c: colour(c) for c in 'rgb'}, a=alpha)}"
            f" FROM ({every}) JOIN (SELECT *, {bits} AS bits FROM px_textures) USING (texture_id)")
    return q.query(body, "px", "px_textures", ctes=[*ways, *ctes, *_rgbm_ctes("hdr"), either, start, *more])


register(
    "x5_convert_mixed",
    lambda s, d: sample_columns(convert.convert_mixed(samples.scale_bias(stored_textures(s, d), "a", *ODD_ALPHA), fx.px_textures(s, d))),
    _mixed_sql(),
)
register(
    "x6_conversion_plan",
    lambda s, d: convert.plan_conversion(fx.px_textures(s, d), max_mips=3).select("texture_id", "format", "alpha_mode", "rgbm", "n_mips", "dds10", "code"),
    q.query(f"""
        SELECT texture_id, format, CASE WHEN format IN ('bc6') OR (rgbm AND format <> 'bc3_rgbm') THEN 'none' WHEN alpha THEN 'transparency'
                                        WHEN NOT alpha THEN 'none' ELSE alpha_mode END AS alpha_mode, rgbm, {q.mip_count('width', 'height', 3, 1)} AS n_mips,
               CASE WHEN format <> 'nonsense' THEN format IN ('bc6', 'bc7') OR starts_with(format, 'astc') END AS dds10,
               CASE WHEN format = 'nonsense' THEN 'format' WHEN alpha_bits > 8 THEN 'alpha_bits' END AS code
        FROM px_textures""", "px", "px_textures"),
)
