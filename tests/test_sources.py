"""Scans and sinks on real files."""

import os
import struct
import zlib

import pytest
from pyspark.sql import Column
from pyspark.sql import functions as F

from texelframe.functions.names import is_container
from texelframe.functions.sql import register_functions
from texelframe.operators import samples
from texelframe.sources import files, formats, images, tables


def write_png(path, rows, alpha=True):
    """Minimal 8-bit RGB(A) PNG from rows of pixel tuples."""
    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    raw = b"".join(b"\0" + bytes(v for p in row for v in p) for row in rows)
    header = struct.pack(">IIBBBBB", len(rows[0]), len(rows), 8, 6 if alpha else 2, 0, 0, 0)
    with open(path, "wb") as f:
        f.write(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


@pytest.fixture
def mixed_folder(tmp_path):
    folder = tmp_path / "in"
    (folder / "deeper").mkdir(parents=True)
    write_png(folder / "a.png", [[(1, 2, 3, 4), (250, 251, 252, 253)]])
    (folder / "b.dds").write_bytes(b"DDS \x7c\x00\x00\x00")
    (folder / "empty.png").write_bytes(b"")
    (folder / ".hidden").write_bytes(b"x")
    (folder / "deeper" / "c.png").write_bytes(b"x")
    return str(folder)


def test_listing_is_one_level_deep(spark, mixed_folder):
    rows = {r.name: r for r in files.scan_files(spark, mixed_folder, with_magic=True).collect()}
    assert set(rows) == {"a.png", "b.dds"}
    assert rows["b.dds"].is_container and not rows["a.png"].is_container
    assert rows["b.dds"].n_bytes == 8 and rows["b.dds"].dir.endswith("/in")


def test_listing_does_not_read_contents(spark, mixed_folder):
    plan = files.scan_files(spark, mixed_folder)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_empty_inputs_are_reported(spark, mixed_folder):
    scanned = files.scan_files(spark, mixed_folder)
    names = os.listdir(mixed_folder)
    wanted = spark.createDataFrame([(f"file:{mixed_folder}/{n}",) for n in names if n.endswith("png")], "path string")
    assert [r.path.rsplit("/")[-1] for r in files.scan_report(wanted, scanned).collect()] == ["empty.png"]


def test_output_names(spark):
    df = spark.createDataFrame([("a", "x.tga"), ("a.b", "y"), ("a", "z.dds")], "dir string, name string")
    assert [r.out_path for r in files.with_output_path(df).collect()] == ["a_out/x.dds", "a.b_out/y.dds", "a_out/z.dds"]
    same = files.with_output_path(df, out_dir=F.col("dir"))
    assert [r.out_path for r in same.collect()] == ["a/x.dds", "a.b/y.dds", "a/z_out.dds"]


def test_images_arrive_in_rgba_order(spark, tmp_path):
    folder = tmp_path / "pngs"
    folder.mkdir()
    write_png(folder / "rgba.png", [[(10, 20, 30, 40), (50, 60, 70, 80)], [(1, 2, 3, 4), (5, 6, 7, 8)]])
    write_png(folder / "rgb.png", [[(10, 20, 30)]], alpha=False)
    (folder / "broken.png").write_bytes(b"not an image")
    rows = images.scan_images(spark, str(folder)).withColumn("name", F.regexp_extract("path", "[^/]*$", 0)).collect()
    got = {(r.name, r.y, r.x): tuple(round(v * 255) for v in (r.r, r.g, r.b, r.a)) for r in rows}
    assert got == {
        ("rgba.png", 0, 0): (10, 20, 30, 40), ("rgba.png", 0, 1): (50, 60, 70, 80),
        ("rgba.png", 1, 0): (1, 2, 3, 4), ("rgba.png", 1, 1): (5, 6, 7, 8), ("rgb.png", 0, 0): (10, 20, 30, 255),
    }


def test_undecodable_images_are_named(spark, tmp_path):
    write_png(tmp_path / "fine.png", [[(1, 2, 3)]], alpha=False)
    (tmp_path / "broken.png").write_bytes(b"not an image")
    rows = images.image_errors(spark, str(tmp_path)).collect()
    assert [(r.path.rsplit("/")[-1], r.code) for r in rows] == [("broken.png", "decode")]


def test_one_read_gives_samples_and_faults(spark, tmp_path):
    from pyspark.sql import Observation

    write_png(tmp_path / "fine.png", [[(1, 2, 3), (4, 5, 6)]], alpha=False)
    (tmp_path / "broken.png").write_bytes(b"not an image")
    (tmp_path / "empty.png").write_bytes(b"")
    seen = Observation("scan")
    rows, faults = images.scan_with_faults(spark, str(tmp_path), seen)
    assert {(r.path.rsplit("/")[-1], r.code) for r in faults.collect()} == {("broken.png", "decode"), ("empty.png", "empty")}
    assert [round(r.r * 255) for r in rows.orderBy("x").collect()] == [1, 4] and "code" not in rows.columns
    assert seen.get == {"n_samples": 2, "n_images": 1, "n_faults": 1}
    for df in (rows, faults):  # neither reads the images again
        assert "stored-" in df._jdf.queryExecution().executedPlan().toString() and "image" not in df._jdf.queryExecution().executedPlan().toString().split("Location")[1][:60]


def test_images_of_a_wrong_length_are_faults(spark):
    def row(k, h, w, n, data):
        return (k, ("p", h, w, n, 0, data))

    schema = "texture_id long, image struct<origin string, height int, width int, nChannels int, mode int, data binary>"
    rows = [row(1, 1, 2, 1, b"\xff\x80"), row(2, 1, 2, 3, b"\x01\x02"), row(3, 1, 1, 3, None), row(4, 0, 0, 3, b""), row(5, -1, -1, -1, b""), row(6, 2, 1, 4, bytes(range(8)))]
    got = images.checked_samples(spark.createDataFrame(rows, schema)).collect()
    assert {(r.texture_id, r.code) for r in got if r.code} == {(2, "size"), (3, "decode"), (4, "decode"), (5, "decode")}
    assert all((r.y, r.x, r.r, r.a) == (None,) * 4 for r in got if r.code)
    assert sorted((r.texture_id, r.y, r.x, round(r.r * 255), round(r.b * 255), r.a) for r in got if not r.code) == [
        (1, 0, 0, 255, 255, 1.0), (1, 0, 1, 128, 128, 1.0), (6, 0, 0, 2, 0, 3 / 255), (6, 1, 0, 6, 4, 7 / 255)]


def test_every_byte_is_decoded(spark):
    df = spark.createDataFrame([(bytearray(range(256)),)] * 3, "content binary")  # no key, equal lines
    out = images.explode_raw(df, 16, 4)
    assert sorted(round(r[c] * 255) for r in out.collect() for c in "rgba") == sorted([*range(256)] * 3)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "hex(" not in text and "conv(" not in text and "hashpartitioning(_buffer" in text


def test_reports_name_every_reason(spark):
    expected = spark.createDataFrame([(p,) for p in ("fine", "empty", "gone", "broken", "both")], "path string")
    scanned = spark.createDataFrame([("fine", 9), ("empty", 0), ("broken", 5), ("other", 0), ("both", 0)], "path string, n_bytes int")
    faults = spark.createDataFrame([("broken", "decode"), ("both", "size"), ("other", "decode")], "path string, code string")
    got = {(r.path, r.code) for r in files.scan_report(expected, scanned, faults).collect()}
    assert got == {("empty", "empty"), ("gone", "missing"), ("broken", "decode"), ("both", "size")}


def test_raw_bgra_buffer(spark):
    df = spark.createDataFrame([(1, bytearray.fromhex("1E140A28463C3250"))], "texture_id long, content binary")
    rows = images.explode_raw(df, 2, 1).orderBy("x").collect()
    assert [tuple(round(v * 255) for v in (r.r, r.g, r.b, r.a)) for r in rows] == [(10, 20, 30, 40), (50, 60, 70, 80)]


def test_raw_size_check(spark):
    df = spark.createDataFrame([("ok", 704, 618, 1_740_288), ("short", 704, 618, 1)], "path string, width int, height int, n_bytes long")
    assert [r.path for r in files.raw_size_check(df).collect()] == ["short"]


def test_planes_are_pruned_on_read(spark, tmp_path):
    df = spark.range(8).select(
        F.col("id").alias("texture_id"), (F.col("id") % 2).cast("int").alias("face"), (F.col("id") % 4).cast("int").alias("mip"),
        F.lit(0).alias("y"), F.lit(0).alias("x"), *[F.lit(0.5).alias(c) for c in "rgba"],
    )
    path = str(tmp_path / "px")
    tables.write_pixels(df, path)
    stored = samples.planes(tables.read_pixels(spark, path), 1, 3).select("texture_id", "r")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(face" in plan and "a:double" not in plan
    assert {r.texture_id for r in stored.collect()} == {3, 7}


def test_plane_names(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 1)], "face int, mip int")
    name = lambda **kw: {r.out_name for r in tables.extract_planes(df, F.lit("d.x/t.dds"), **kw).collect()}
    assert name() == {"d.x/t.tga"}
    assert name(faces=True) == {"d.x/t_face0.tga", "d.x/t_face1.tga"}
    assert name(faces=True, mips=True, extension=".png") == {"d.x/t_face0_mipmap0.png", "d.x/t_face1_mipmap0.png", "d.x/t_face0_mipmap1.png"}


def test_format_dimension(spark):
    rows = {r.format: r for r in formats.format_dim(spark).collect()}
    assert len(rows) == 31
    assert (rows["bc1"].block_bytes, rows["bc7"].block_bytes, rows["astc_ldr_12x10"].block_w) == (8, 16, 12)
    assert {f for f, r in rows.items() if r.dds10} == {"bc6", "bc6s", "bc7"} | {f for f in rows if f.startswith("astc")}
    assert rows["bc5s"].pixel_type == "signed_norm" and rows["bc6"].pixel_type == "unsigned_float"


def test_size_of_one_level(spark):
    df = spark.createDataFrame([(1, 704, 618, 1, "bc7")], "texture_id long, width int, height int, depth int, format string")
    assert formats.size_estimate(df, max_mips=1).first().total_bytes == 436_480


def test_magic_needs_all_four_bytes(spark):
    df = spark.createDataFrame([(bytearray(b"DDS "),), (bytearray(b"DDS"),), (bytearray(b"dds "),)], "c binary")
    assert [r[0] for r in df.select(is_container(F.col("c"))).collect()] == [True, False, False]


def test_sql_functions_leave_no_udf(spark):
    register_functions(spark)
    df = spark.range(3).selectExpr("tf_srgb_decode(id / 2D) AS v", "tf_snorm(id - 1D, 8) AS s")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "tf_" not in plan and "UDF" not in plan
    assert [r.s for r in df.collect()] == [-1.0, 0.0, 1.0]


def test_sql_functions_equal_the_operators(spark, folder):
    """Each registered function against its operator, over samples."""
    from texelframe.functions import color, quantize
    from texelframe.functions.sql import FUNCTIONS
    from workload import fixtures as fx

    register_functions(spark)
    px = fx.px(spark, folder)
    rgb, a = [F.col(c) for c in "rgb"], F.col("a")
    calls = {  # arguments in SQL, and what an operator does with the same numbers
        "tf_clamp": ("r, 0.25D, 2D", color.clamp(F.col("r"), 0.25, 2.0)),
        "tf_scale_bias": ("r, 3D, -1D", color.scale_bias(F.col("r"), 3.0, -1.0)),
        "tf_gamma_encode": ("r, 2.2D", samples.to_gamma(px, 2.2)), "tf_gamma_decode": ("r, 2.2D", samples.to_linear(px, 2.2)),
        "tf_srgb_decode_unclamped": ("r", samples.to_linear_from_srgb_unclamped(px)), "tf_srgb_encode_unclamped": ("r", samples.to_srgb_unclamped(px)),
        "tf_srgb_decode": ("r", samples.to_linear_from_srgb(px)), "tf_srgb_encode": ("r", samples.to_srgb(px)),
        "tf_unorm": ("r, 5", samples.quantize_unorm(px, 5)), "tf_snorm": ("r, 5", samples.quantize_snorm(px, 5)),
        "tf_binary_alpha": ("a, 100", quantize.above_threshold(a, 100)), "tf_premultiply": ("r, a", samples.premultiply(px)),
        "tf_demultiply": ("r, a", samples.demultiply(px)), "tf_slope": ("r, b", samples.to_slope_space(px)),
        "tf_tone_map": ("r, r, g, b", samples.tone_map_linear(px)), "tf_rgbm_multiplier": ("r, g, b, 0.15D", color.rgbm_multiplier(*rgb)),
        "tf_rgbm_encode": ("r, r, g, b, 0.15D", samples.to_rgbm(px)), "tf_rgbm_alpha": ("r, g, b, 0.15D", color.rgbm_alpha(*rgb)),
        "tf_rgbm_decode": ("r, a, 0.15D", samples.from_rgbm(px)), "tf_normalize": ("r, r, g, b, 0.5D", samples.normalize_normals(px)),
        "tf_grey": ("r, g, b, a, 2D, 4D, 1D, 0D", samples.to_grey(px, 2.0, 4.0, 1.0, 0.0)), "tf_dither": ("a, x, y, 3", quantize.ordered_dither(a, F.col("x"), F.col("y"), 3)),
        "tf_reinhard": ("r, 2.2D", color.reinhard(F.col("r"), 2.2)),
    }
    assert set(calls) == set(FUNCTIONS)
    key = ["texture_id", "y", "x"]
    wanted = px.select(*key, *[v.alias(f) for f, (_, v) in calls.items() if isinstance(v, Column)])
    for f, (_, v) in calls.items():
        if not isinstance(v, Column):
            wanted = wanted.join(v.select(*key, F.col("r").alias(f)), key)
    got = px.selectExpr(*key, *[f"{f}({args}) AS s_{f}" for f, (args, _) in calls.items()])
    both = wanted.join(got, key)
    off = both.agg(*[F.count(F.when(~F.col(f).eqNullSafe(F.col(f"s_{f}")) & ~(F.abs(F.col(f) - F.col(f"s_{f}")) < 1e-12), 1)).alias(f) for f in calls]).first()
    assert both.count() == px.count() and off.asDict() == dict.fromkeys(calls, 0)


def test_table_functions_give_plans_and_sizes(spark):
    from texelframe.functions.sql import register_table_functions

    register_table_functions(spark)
    rows = [(1, 704, 618, "bc7"), (2, 9, 5, "bc1"), (3, 1, 1, "rgb"), (4, 13, 40, "astc_ldr_12x10"), (5, 8, 8, "what"), (6, 8, 8, None)]
    textures = spark.createDataFrame(rows, "texture_id long, width int, height int, format string").withColumn("depth", F.lit(1))
    textures.createOrReplaceTempView("some_textures")
    for most, least in ((32, 1), (3, 1), (32, 4), (32, 1000), (0, 1)):
        plan = spark.sql(f"SELECT texture_id, mip, mip_width, mip_height FROM some_textures, LATERAL tf_mip_plan(width, height, {most}, {least})")
        assert sorted(plan.collect()) == sorted(formats.mip_plan(textures, most, least).select(*plan.columns).collect())
    sizes = spark.sql("SELECT texture_id, n_mips, total_bytes FROM some_textures, LATERAL tf_size_estimate(width, height, format)")
    assert sorted(sizes.collect()) == sorted(formats.size_estimate(textures).select("texture_id", F.col("n_mips").cast("int"), "total_bytes").collect())
    text = sizes._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in text and "NestedLoop" not in text and "UDF" not in text


def test_rebalanced_write_keeps_every_sample(spark, folder, tmp_path):
    from workload import fixtures as fx

    px = fx.px(spark, folder)
    path = str(tmp_path / "even")
    tables.write_pixels(px, path, rebalance=True)
    assert tables.read_pixels(spark, path).select(*px.columns).exceptAll(px).count() == 0
    assert tables.read_pixels(spark, path).count() == px.count()
