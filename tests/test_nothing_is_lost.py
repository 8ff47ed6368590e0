"""Inputs that used to lose rows, change results by size, or end a job."""

import numpy as np
import pytest
from helpers import image, random_image, to_array
from pyspark.sql import functions as F

from texelframe.functions.sizes import mip_size
from texelframe.operators import batches, metrics, pairs, stitch
from texelframe.plans import compare, convert, pyramid
from texelframe.session import shared_folder
from texelframe.sources import formats

PART = ("base string, file string, layer_file bigint, face_file bigint, mip_file bigint, n_layers int, n_faces int, n_mips int, width int, height int, "
        "depth int, format string, alpha_mode string, color_transform string, layer int, face int, mip int")


def part(layer_file, n_layers=1, mip_file=0, n_mips=1, size=8):
    return ("t", f"f{layer_file}_{mip_file}", layer_file, 0, mip_file, n_layers, 1, n_mips, size, size, 1, "bc7", "none", "none", 0, 0, 0)


def test_last_histogram_bin_may_be_short(spark):
    bright = image(spark, np.ones((4, 4, 4)) * 100)
    got = {r.bin: r.value for r in metrics.histogram(bright, bins=100, reduce=3).filter("channel = 'r'").collect()}
    assert len(got) == 34 and got[33] == 16.0 and sum(got.values()) == 16.0


def test_levels_from_32_on_have_one_sample(spark):
    row = spark.range(1).select(*[mip_size(F.lit(64), level).alias(f"l{level}") for level in (5, 6, 31, 32, 33, 64)]).first()
    assert list(row) == [2, 1, 1, 1, 1, 1]


def test_images_with_holes_have_one_pyramid(spark, monkeypatch):
    samples = image(spark, random_image(8, 8)).filter("(x * 5 + y * 3) % 7 > 1")
    samples = samples.withColumns({"width": F.lit(8), "height": F.lit(8)})
    order = ["mip", "y", "x"]
    nested = pyramid.pyramid(samples).orderBy(*order).select(*order, "r", "g", "b", "a").collect()
    monkeypatch.setattr(pyramid, "_nests", lambda: F.lit(False))
    chained = pyramid.pyramid(samples).orderBy(*order).select(*order, "r", "g", "b", "a").collect()
    assert [tuple(r)[:3] for r in nested] == [tuple(r)[:3] for r in chained]
    assert np.array([tuple(r)[3:] for r in nested]) == pytest.approx(np.array([tuple(r)[3:] for r in chained]))


def test_unequal_images_are_not_reported_equal(spark):
    whole = image(spark, random_image(8, 8)).withColumn("texture_id", F.explode(F.array(*[F.lit(k).cast("long") for k in range(4)])))
    other = whole.filter("texture_id = 0 or (texture_id = 1 and x < 2 and y < 2) or (texture_id = 2 and not (x = 3 and y = 3))")
    other = other.unionByName(whole.filter("texture_id = 0").withColumn("texture_id", F.lit(9).cast("long")))
    for rangescale in (False, True):
        got = {r.texture_id: r for r in compare.compare_images(whole, other, rangescale=rangescale).collect()}
        assert {k: r.code for k, r in got.items()} == {0: None, 1: "size", 2: "samples", 3: "missing_other", 9: "missing_reference"}
        assert all((r.rmse is None) == (k != 0) and (r.identical is None) == (k != 0) for k, r in got.items())


def test_channels_of_a_smaller_image_leave_the_rest(spark):
    a, b = random_image(8, 8, 1), random_image(8, 8, 2)
    small = image(spark, b).filter("x < 2 and y < 2")
    copied, added = a.copy(), a.copy()
    copied[:2, :2, 0] = b[:2, :2, 1]
    added[:2, :2, 0] += b[:2, :2, 1]
    assert to_array(pairs.copy_channel_from(image(spark, a), small, "g", "r")) == pytest.approx(copied)
    assert to_array(pairs.add_channel(image(spark, a), small, "g", "r")) == pytest.approx(added)


def test_long_numbers_in_names_end_nothing(spark):
    names = ["a_L0_F0_M0.dds", "shot_L0_F0_M20240101123456.dds", "b_L4294967295_F0_1.dds", "c_L99999999999999999999_F0_M0.dds", "other.dds"]
    files = spark.createDataFrame([(n,) for n in names], "file string")
    assert {r.base: r.layer_file for r in stitch.parse_parts(files).collect()} == {"a": 0, "b": 4294967295}
    assert {(r.file[:4], r.axis) for r in stitch.part_name_errors(files).collect()} == {("shot", "mip_file"), ("c_L9", "layer_file")}


def test_large_textures_neither_overflow_nor_wrap(spark):
    many = spark.createDataFrame([part(k, n_layers=40_000_000) for k in range(60)], PART)
    assert stitch.stitch(many).agg(F.max("layer")).first()[0] == 59 * 40_000_000
    assert stitch.stitch_limits(many).count() == 0
    deep = spark.createDataFrame([part(0, n_mips=20, size=64), part(0, mip_file=1, n_mips=20, size=1), part(0, mip_file=2, n_mips=20, size=1)], PART)
    assert stitch.stitch_errors(deep).count() == 0


def test_folders_and_sizes_may_be_null(spark):
    files = spark.createDataFrame([(None, "a", 60), (None, "b", None), (None, "c", 60), ("d", "e", 10)], "dir string, path string, n_bytes long")
    got = {r.path: r.batch_id for r in batches.assign_batches(files, 100, 10, chunk_files=10).collect()}
    assert got == {"a": 0, "b": 0, "c": 1, "e": 0}
    with pytest.raises(ValueError):
        batches.assign_batches(files, 100, 10**9)


def test_unknown_formats_stay_and_are_named(spark):
    textures = spark.createDataFrame([(1, "bc7", 8, 8, 1, 2, 6), (2, "BC7", 8, 8, 1, 1, 1), (3, None, 8, 8, 1, 1, 1)],
                                     "texture_id long, format string, width int, height int, depth int, n_layers int, n_faces int")
    sizes = {r.texture_id: r.total_bytes for r in formats.size_estimate(textures).collect()}
    assert sizes == {1: (4 + 1 + 1 + 1) * 16 * 12, 2: None, 3: None}
    assert sorted(r.texture_id for r in formats.unknown_formats(textures).collect()) == [2, 3]


def test_conversion_keeps_stored_levels_and_luminance(spark):
    base = image(spark, random_image(4, 4)).withColumns({"mip": F.lit(0), "width": F.lit(4), "height": F.lit(4)})
    stored = base.filter("x < 2 and y < 2").withColumns({"mip": F.lit(1), "width": F.lit(2), "height": F.lit(2), **{c: F.lit(0.9) for c in "rgba"}})
    both = base.unionByName(stored)
    level = lambda df: {round(r.r, 2) for r in df.filter("mip = 1").collect()}
    assert level(convert.convert(both)) == {0.9} and level(convert.convert(both, reuse_levels=False)) != {0.9}
    lumi = convert.convert(base, "lumi").first()
    assert "g" not in lumi.asDict() or lumi.g == lumi.r
    normal = pyramid.pyramid_from_source(both, normal=True).filter("mip = 2").first()
    assert (2 * normal.r - 1) ** 2 + (2 * normal.g - 1) ** 2 + (2 * normal.b - 1) ** 2 == pytest.approx(1.0)
    assert [r.first_mip for r in pyramid.faces_without_base(stored).collect()] == [1]


def test_a_checkpoint_folder_has_to_be_named():
    class Unnamed:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError):
        shared_folder(Unnamed)
