"""Whole conversions and the entry points."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from texelframe.operators import metrics, samples
from texelframe.plans import compare, convert
from tests.helpers import image, random_image, to_array
from workload.queries import ORACLES, QUERIES


def test_unknown_format_is_refused(spark):
    with pytest.raises(ValueError):
        convert.quantize_for_format(image(spark, random_image(2, 2)), "bc9")


def test_storage_precisions(spark):
    array = random_image(4, 4)
    df = image(spark, array)
    assert to_array(convert.quantize_for_format(df, "bc6")) == pytest.approx(array)
    assert set(to_array(convert.quantize_for_format(df, "bc1a"), "a").ravel()) <= {0.0, 1.0}
    dithered = to_array(convert.quantize_for_format(df, "bc2", alpha_dithering=True), "a") * 15
    assert dithered == pytest.approx(np.round(dithered))
    assert "g" not in convert.quantize_for_format(df, "rgb", luminance=True).columns


def test_normal_map_conversion_has_unit_normals_at_every_level(spark):
    out = convert.convert(image(spark, random_image(8, 8)), "bc6", to_normal=True).toPandas()
    assert set(out.mip) == {0, 1, 2, 3}
    n = out[["r", "g", "b"]].to_numpy() * 2 - 1
    assert np.linalg.norm(n, axis=1) == pytest.approx(1)


def test_format_that_adds_its_own_multiplier_keeps_alpha(spark):
    array = random_image(2, 2)
    levels = convert.convert(image(spark, array), "bc3_rgbm", rangescale=True, max_mips=1)
    assert to_array(levels, "a") == pytest.approx(np.floor(array[..., 3:] * 255 + 0.5) / 255)


def two_levels(spark, size=8):
    base = image(spark, random_image(size, size), sized=True).withColumn("mip", F.lit(0))
    stored = image(spark, np.full((size // 2, size // 2, 4), 0.9), sized=True).withColumn("mip", F.lit(1))
    return base.unionByName(stored)


def level(df, mip, channel="r"):
    return to_array(df.filter(F.col("mip") == mip), channel)


def test_stored_levels_are_kept_unless_the_image_changes(spark):
    df = two_levels(spark)
    kept = convert.convert(df, "bc6")
    assert level(kept, 1) == pytest.approx(0.9) and level(kept, 2) == pytest.approx(0.9)
    again = convert.convert(df, "bc6", reuse_levels=False)
    assert abs(level(again, 1) - 0.9).max() > 0.05
    for changed in ({"rgbm": True}, {"format": "bc3_rgbm"}, {"to_normal": True}):
        made = convert.convert(df, **{"format": "bc6", **changed})
        assert {r.mip for r in made.select("mip").distinct().collect()} == {0, 1, 2, 3}
        assert level(made, 1).std() > 0
        with pytest.raises(ValueError):
            convert.convert(df, reuse_levels=True, **changed)
    # without sizes in the table as well
    assert level(convert.convert(df.drop("width", "height"), "bc6"), 2) == pytest.approx(0.9)


def test_dithering_outside_bc1a_and_bc2_needs_alpha(spark):
    df = image(spark, random_image(8, 8))
    alpha = lambda *a, **k: to_array(convert.quantize_for_format(df, *a, alpha_dithering=True, **k), "a")
    plain = to_array(convert.quantize_for_format(df, "bc7"), "a")
    assert (alpha("bc7") == plain).all() and (alpha("bc7", alpha=False) == plain).all()
    assert (alpha("bc7", alpha=True, alpha_bits=2) * 3 == pytest.approx(np.round(alpha("bc7", alpha=True, alpha_bits=2) * 3)))
    assert set(alpha("bc1a").ravel()) == {0.0, 1.0} and (alpha("bc1a") != to_array(convert.quantize_for_format(df, "bc1a"), "a")).any()
    with pytest.raises(ValueError):
        convert.quantize_for_format(df, "bc7", alpha_bits=9)


def test_a_mixed_job_gives_what_each_format_alone_gives(spark):
    formats = ["bc7", "bc1a", "bc2", "bc4s", "bc6", "lumi", "bc3_rgbm", "rgb"]
    df, rows = None, []
    for k, name in enumerate(formats):
        one = two_levels(spark, 8).withColumn("texture_id", F.lit(k).cast("long"))
        df = one if df is None else df.unionByName(one)
        rows.append((k, 8, 8, name, True, True, False))
    rows += [(50, 8, 8, "rgb", True, True, True), (60, 8, 8, "what", True, True, False), (61, 8, 8, None, True, True, False), (62, 0, 8, "bc7", True, True, False)]
    for k in (50, 60, 77):
        df = df.unionByName(two_levels(spark, 8).withColumn("texture_id", F.lit(k).cast("long")))
    textures = spark.createDataFrame(rows, "texture_id long, width int, height int, format string, alpha boolean, alpha_dithering boolean, rgbm boolean")
    mixed = convert.convert_mixed(df, textures, max_mips=3).toPandas()
    assert set(mixed.texture_id) == {*range(8), 50}
    order = ["mip", "y", "x"]
    for k, name in [*enumerate(formats), (50, "rgb")]:
        own = df.filter(F.col("texture_id") == k)
        alone = convert.convert(own, name, max_mips=3, alpha_dithering=True, alpha=True, rgbm=k == 50, rangescale=k in (6, 50)).toPandas().sort_values(order)
        part = mixed[mixed.texture_id == k].sort_values(order)
        assert part[order].values.tolist() == alone[order].values.tolist()
        for c in "r" if name == "lumi" else "rgba":
            assert part[c].tolist() == pytest.approx(alone[c].tolist()), (name, c)
    assert mixed[mixed.texture_id == 5][["g", "b", "a"]].isna().all().all()
    faults = {(r.texture_id, r.code) for r in convert.conversion_faults(df, textures).collect()}
    assert faults == {(60, "format"), (61, "format"), (62, "size"), (77, "texture")}


def test_plans_settle_alpha(spark):
    rows = [(1, "bc7", "straight", None), (2, "bc7", "straight", True), (3, "bc7", "straight", False), (4, "bc6", "straight", True)]
    textures = spark.createDataFrame(rows, "texture_id long, format string, alpha_mode string, alpha boolean").withColumns({"width": F.lit(4), "height": F.lit(4)})
    plan = {r.texture_id: r.alpha_mode for r in convert.plan_conversion(textures).collect()}
    assert plan == {1: "straight", 2: "transparency", 3: "none", 4: "none"}


def test_named_rgbm_images_compare_as_equal(spark):
    """Decoding what the name announces brings an encoded image back to the reference."""
    array = random_image(6, 5) * 0.9 + 0.1
    reference = image(spark, array)
    encoded = samples.to_rgbm(samples.to_gamma(metrics.range_scale(reference), 2.2))
    from texelframe.operators.pairs import pair

    pairs = pair(reference, encoded)
    report = compare.compare_pairs(pairs, F.lit("x/wall_rgbm.dds")).first()
    assert report.rmse < 1e-6 and report.rmse_alpha == 0
    plain = compare.compare_pairs(pairs, F.lit("x/wall.dds")).first()
    assert plain.rmse > 0.05


def test_entry_points(spark):
    assert entry_points.entry(spark).count() == 4
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(QUERIES) - set(ORACLES) == {"s1_scan_files"}
