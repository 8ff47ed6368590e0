"""Known values of the colour and alpha operators."""

import pytest
from pyspark.sql import functions as F

from texelframe.operators import metrics, pairs, resample, samples
from texelframe.plans import pyramid as pyramids
from tests.helpers import image, random_image, to_array
import numpy as np


def one(spark, r, g, b, a):
    return image(spark, np.array([[[r, g, b, a]]]))


def test_srgb_light_ratio(spark):
    full, half = (samples.to_linear_from_srgb(one(spark, v, v, v, 1)).first().r for v in (1.0, 127 / 255))
    assert full / half == pytest.approx(4.71, abs=0.01)


def test_checkerboard_averages_in_linear_light(spark):
    board = np.zeros((2, 2, 4))
    board[0, 0] = board[1, 1] = 1
    levels = pyramids.pyramid(image(spark, board)).filter("mip = 1")
    assert 187 <= levels.first().r * 255 < 188


def test_blend_with_and_without_premultiplied_alpha(spark):
    strip = image(spark, np.array([[[1, 0, 0, 1.0], [0, 1, 0, 0.0001]]]))
    plain = resample.next_mip(strip).first()
    assert (plain.r, plain.g, plain.b, plain.a) == pytest.approx((0.5, 0.5, 0, 0.50005))
    better = samples.demultiply(resample.next_mip(samples.premultiply(strip))).first()
    assert (better.r, better.g, better.b, better.a) == pytest.approx((1, 0.0001, 0, 0.50005), abs=2e-4)


def test_eight_bit_values_survive_eight_bit_quantisation(spark):
    df = spark.range(256).select((F.col("id") / 255).alias("r"))
    kept = samples.quantize_unorm(df, 8).join(df.withColumnRenamed("r", "was"), F.col("r") == F.col("was"))
    assert kept.count() == 256


def test_slope_space_leaves_flat_samples(spark):
    flat = samples.to_slope_space(one(spark, 0.3, 0.4, 0.0, 1)).first()
    assert (flat.r, flat.g) == (0.3, 0.4)
    tilted = samples.to_slope_space(one(spark, 0.3, 0.4, 0.5, 1)).first()
    assert tilted.r == pytest.approx(0.5 * (2 * 0.3 - 1) / 0.5 + 0.5)


@pytest.mark.parametrize(
    "there, back",
    [
        (samples.to_srgb, samples.to_linear_from_srgb),
        (samples.to_srgb_unclamped, samples.to_linear_from_srgb_unclamped),
        (samples.to_gamma, samples.to_linear),
        (samples.premultiply, samples.demultiply),
    ],
)
def test_round_trips(spark, there, back):
    array = random_image(4, 4)
    array[..., 3] += 0.01
    assert to_array(back(there(image(spark, array)))) == pytest.approx(array, abs=1e-12)


def test_rgbm_round_trip_within_range(spark):
    array = random_image(4, 4)
    decoded = to_array(samples.from_rgbm(samples.to_rgbm(image(spark, array))), "rgb")
    assert decoded == pytest.approx(array[..., :3], abs=1e-12)


def test_tone_map_keeps_ratios(spark):
    row = samples.tone_map_linear(one(spark, 4.0, 2.0, 1.0, 1)).first()
    assert (row.r, row.g, row.b) == (1.0, 0.5, 0.25)


def test_zero_normal_points_up(spark):
    row = samples.normalize_normals(one(spark, 0.5, 0.5, 0.5, 1)).first()
    assert (row.r, row.g, row.b) == (0.5, 0.5, 1.0)


@pytest.mark.parametrize("bits", [0, 9])
def test_dither_bits_are_checked(spark, bits):
    with pytest.raises(ValueError):
        samples.dither_alpha(one(spark, 0, 0, 0, 0), bits)


def test_identical_images(spark):
    a = image(spark, random_image(5, 3))
    row = metrics.diff_report(pairs.pair(a, a), normals=True).first()
    assert row.rmse == 0 and row.psnr is None and row.identical and row.angular_error == pytest.approx(0, abs=1e-7)


def test_range_scale_of_black_image(spark):
    assert to_array(metrics.range_scale(image(spark, np.zeros((3, 3, 4))))).max() == 0


def test_pair(spark):
    a, b = random_image(20, 7, 1), random_image(20, 7, 2)
    diff = to_array(pairs.diff_image(pairs.pair(image(spark, a), image(spark, b))))
    assert diff == pytest.approx(np.abs(a - b))
