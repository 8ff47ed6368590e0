"""Resampling, stencils and pyramids against array code, across tile borders."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from texelframe.functions import sizes
from texelframe.operators import resample, samples, stencil
from texelframe.plans import pyramid as pyramids
from tests.helpers import axis_weights, image, random_image, resized, to_array


@pytest.mark.parametrize("name", ["box", "triangle", "mitchell", "kaiser"])
@pytest.mark.parametrize("wrap", ["clamp", "repeat"])
def test_next_mip_spans_tiles(spark, name, wrap):
    array = random_image(137, 150)
    level = to_array(resample.next_mip(image(spark, array), name, wrap))
    wrap = "clamp" if name == "box" else wrap
    assert level == pytest.approx(resized(array, 75, 68, name, wrap), abs=1e-9)


@pytest.mark.parametrize("name", ["box", "triangle", "mitchell", "kaiser"])
def test_resize_up_and_down(spark, name):
    array = random_image(11, 40)
    out = to_array(resample.resize(image(spark, array), 13, 23, name))
    assert out == pytest.approx(resized(array, 13, 23, name), abs=1e-9)


@pytest.mark.parametrize("name", ["triangle", "mitchell", "kaiser"])
@pytest.mark.parametrize("wrap", ["clamp", "repeat"])
@pytest.mark.parametrize("size", [(5, 7), (1, 3), (60, 2), (3, 50)])
def test_strong_reductions(spark, name, wrap, size):
    array = random_image(53, 66)
    out = resample.resize(image(spark, array), *size, name, wrap)
    assert to_array(out) == pytest.approx(resized(array, *size, name, wrap), abs=1e-9)
    assert {(r.width, r.height) for r in out.select("width", "height").distinct().collect()} == {size}


def test_images_of_one_table_go_each_their_way(spark):
    arrays = [random_image(9, 12, 1), random_image(80, 9, 2), random_image(6, 90, 3)]
    df = image(spark, arrays[0], 0).unionByName(image(spark, arrays[1], 1)).unionByName(image(spark, arrays[2], 2))
    out = resample.resize(df, 6, 6, "mitchell", "repeat")
    for k, array in enumerate(arrays):
        assert to_array(out.filter(F.col("texture_id") == k)) == pytest.approx(resized(array, 6, 6, "mitchell", "repeat"), abs=1e-9)


@pytest.mark.parametrize("wrap", ["clamp", "repeat"])
def test_repeats_have_weight_each_and_nulls_weight_without_value(spark, wrap):
    """The samples of a place are summed with their number, and a line's samples before the lines."""
    array = random_image(9, 40)[..., 0]
    rows = [(0, y, x, float(array[y, x])) for y in range(9) for x in range(40)]
    rows = [r for r in rows if r[1:3] not in ((3, 4), (3, 5)) and r[1] != 6]
    rows += [(0, 2, 2, 5.0), (0, 2, 2, None), (0, 7, 39, None), (0, 0, 0, 0.5)]
    rows = [(*r[:3], None) if r[1:3] == (5, 20) else r for r in rows]
    df = spark.createDataFrame(rows, "texture_id long, y int, x int, a double")
    out = {(r.y, r.x): r.a for r in resample.resize(df, 50, 13, "mitchell", wrap).collect()}
    known, number = np.zeros((9, 40)), np.zeros((9, 40))
    for _, y, x, a in rows:
        known[y, x] += a or 0
        number[y, x] += 1
    across, down = axis_weights("mitchell", 40, 50, wrap), axis_weights("mitchell", 9, 13, wrap)
    read = (number @ (across != 0).T) > 0
    lines = np.divide(known @ across.T, number @ across.T, out=np.zeros(read.shape), where=read)
    expected = (down @ lines) / (down @ read)
    assert len(out) == 50 * 13
    assert np.array([[out[y, x] for x in range(50)] for y in range(13)]) == pytest.approx(expected, abs=1e-9)


def test_extremes_bound_the_mean_and_join_odd_edges(spark):
    array = random_image(7, 5)
    low, mean, high = (to_array(resample.next_mip(image(spark, array), n)) for n in ("min", "box", "max"))
    assert (low <= mean + 1e-12).all() and (mean <= high + 1e-12).all()
    assert high[2, 1] == pytest.approx(array[4:7, 2:5].max(axis=(0, 1)))


def test_one_dimensional_images(spark):
    array = random_image(1, 6)
    for name in ("box", "kaiser", "max"):
        assert to_array(resample.next_mip(image(spark, array), name)).shape == (1, 3, 4)


def test_unknown_names_are_refused(spark):
    df = image(spark, random_image(2, 2))
    with pytest.raises(ValueError):
        resample.next_mip(df, "lanczos")
    with pytest.raises(ValueError):
        resample.resize(df, 1, 1, "min")
    with pytest.raises(ValueError):
        resample.next_mip(df, "kaiser", "mirror")


def chain(array, name, levels):
    out = []
    for _ in range(levels):
        h, w, _ = array.shape
        array = resized(array, max(1, w // 2), max(1, h // 2), name)
        out.append(array)
    return out


def test_nested_pyramid_beyond_one_tile(spark):
    """512x256 has more levels than one tile holds."""
    array = random_image(256, 512)
    df = image(spark, array, sized=True).repartition(4)
    levels = pyramids.pyramid(df, "box", gamma=False).cache()
    assert levels.agg(F.max("mip")).first()[0] == 9
    for mip, expected in enumerate(chain(array, "box", 9), start=1):
        assert to_array(levels.filter(F.col("mip") == mip)) == pytest.approx(expected, abs=1e-9)


def test_mixed_sizes_take_both_ways(spark):
    arrays = {1: random_image(8, 8, 1), 2: random_image(9, 14, 2), 3: random_image(1, 1, 3)}
    df = None
    for key, array in arrays.items():
        one = image(spark, array, key)
        df = one if df is None else df.unionByName(one)
    levels = pyramids.pyramid(df, "box", gamma=False).cache()
    for key, array in arrays.items():
        mine = levels.filter(F.col("texture_id") == key)
        assert to_array(mine.filter("mip = 0")) == pytest.approx(array)
        n = int(np.log2(max(array.shape[:2])))
        assert mine.agg(F.max("mip")).first()[0] == n
        for mip, expected in enumerate(chain(array, "box", n), start=1):
            assert to_array(mine.filter(F.col("mip") == mip)) == pytest.approx(expected, abs=1e-9)


def test_pyramid_limits(spark):
    df = image(spark, random_image(16, 16))
    assert pyramids.pyramid(df, max_mips=3).select("mip").distinct().count() == 3
    assert pyramids.pyramid(df, max_mips=1).select("mip").distinct().count() == 1
    assert pyramids.pyramid(df, min_size=4).select("mip").distinct().count() == 3


def test_alpha_pyramid_equals_step_by_step_conversion(spark):
    array = random_image(8, 8, 5)
    levels = pyramids.pyramid_alpha(image(spark, array)).cache()
    current = image(spark, array)
    for mip in (1, 2, 3):
        current = samples.premultiply(samples.to_linear_from_srgb(current))
        current = samples.to_srgb(samples.demultiply(resample.next_mip(current)))
        assert to_array(levels.filter(F.col("mip") == mip)) == pytest.approx(to_array(current), abs=1e-9)


def test_normal_pyramid_has_unit_normals(spark):
    levels = pyramids.pyramid_normal(image(spark, random_image(8, 6))).filter("mip > 0").toPandas()
    n = levels[["r", "g", "b"]].to_numpy() * 2 - 1
    assert np.linalg.norm(n, axis=1) == pytest.approx(1)


def test_from_source_keeps_each_face_up_to_its_gap(spark):
    array = random_image(8, 8)
    base = image(spark, array, sized=True).withColumn("mip", F.lit(0))
    marks = []
    for face, mips in ((0, (1, 2)), (1, (1, 3)), (2, (2,))):
        df = base.withColumn("face", F.lit(face))
        marks.append(df)
        for mip in mips:
            size = 8 >> mip
            grid = spark.range(size * size).select(
                F.lit(0).cast("long").alias("texture_id"), F.lit(face).alias("face"), F.lit(mip).alias("mip"),
                (F.col("id") / size).cast("int").alias("y"), (F.col("id") % size).cast("int").alias("x"),
                *[F.lit(7.0 + mip).alias(c) for c in "rgba"], F.lit(size).alias("width"), F.lit(size).alias("height"),
            )
            marks.append(grid)
    stored = marks[0]
    for m in marks[1:]:
        stored = stored.unionByName(m)
    out = pyramids.pyramid_from_source(stored, gamma=False).cache()
    top = {(r.face, r.mip): r.m for r in out.groupBy("face", "mip").agg(F.max("r").alias("m")).collect()}
    assert {k[1] for k in top} == {0, 1, 2, 3} and len(top) == 12
    assert top[0, 2] == 9 and top[0, 3] == pytest.approx(9)  # generated from stored level 2
    assert top[1, 1] == 8 and top[1, 2] == pytest.approx(8) and top[1, 3] == pytest.approx(8)  # stored 3 ignored
    assert top[2, 1] <= 1 and top[2, 2] <= 1  # stored 2 lies beyond the gap
    assert out.groupBy("face", "mip", "y", "x").count().filter("count > 1").count() == 0


@pytest.mark.parametrize("wrap", ["clamp", "repeat"])
def test_normal_map_spans_tiles(spark, wrap):
    array = random_image(70, 133)
    weights = (1.0, 0.5, 0.25, 0.125)
    h = array[..., 3]
    mode = {"clamp": "edge", "repeat": "wrap"}[wrap]
    p = np.pad(h, 4, mode=mode)
    def at(dy, dx):
        return p[4 + dy : 4 + dy + h.shape[0], 4 + dx : 4 + dx + h.shape[1]]

    sx = sum(w * (at(0, k) - at(0, -k)) / (2 * k) for k, w in enumerate(weights, 1))
    sy = sum(w * (at(k, 0) - at(-k, 0)) / (2 * k) for k, w in enumerate(weights, 1))
    length = np.sqrt(sx**2 + sy**2 + 1)
    expected = np.stack([-sx / length, -sy / length, 1 / length, h], axis=-1)
    out = to_array(stencil.to_normal_map(image(spark, array), *weights, wrap=wrap))
    assert out == pytest.approx(expected, abs=1e-12)


@pytest.mark.parametrize(
    "width, height, cap, small, expected",
    [(704, 618, 32, 1, 10), (704, 618, 0, 1, 1), (704, 618, 1, 1, 1), (704, 618, 2, 1, 2), (704, 618, 32, 64, 4),
     (1, 1, 32, 1, 1), (3, 1000, 32, 1, 10), (8, 8, 32, 16, 1)],
)
def test_mip_count(spark, width, height, cap, small, expected):
    count = sizes.mip_count(F.lit(width), F.lit(height), cap, small)
    assert spark.range(1).select(count).first()[0] == expected


def test_block_count(spark):
    row = spark.range(1).select(sizes.block_count(F.lit(704), F.lit(618), 4, 4)).first()
    assert row[0] == 27_280


@pytest.mark.parametrize("wrap", ["clamp", "repeat"])
def test_normals_of_images_with_holes(spark, wrap):
    """Absent samples add nothing to slopes and have no normal, whole absent lines included."""
    rng = np.random.default_rng(5)
    h, w = 75, 70
    heights = rng.random((h, w))
    there = rng.random((h, w)) > 0.1
    there[10:22], there[:, 64:66], there[0, 0], there[-1, -1] = False, False, True, True
    df = image(spark, np.dstack([heights] * 4)).filter(F.col("y") >= 0)
    keep = spark.createDataFrame([(int(y), int(x)) for y, x in zip(*np.nonzero(there))], "y int, x int")
    weights = (1.0, 0.5, 0.25, 2.0)
    got = {(r.y, r.x): (r.r, r.g, r.b, r.a) for r in stencil.to_normal_map(df.join(keep, ["y", "x"]), *weights, wrap=wrap).collect()}
    assert set(got) == {(y, x) for y, x in zip(*np.nonzero(there))}
    held = np.where(there, heights, 0.0)

    def at(y, x):
        return held[y % h, x % w] if wrap == "repeat" else held[min(max(y, 0), h - 1), min(max(x, 0), w - 1)]

    for (y, x), (r, g, b, a) in list(got.items())[::7]:
        sx = sum(v / (2 * k) * (at(y, x + k) - at(y, x - k)) for k, v in enumerate(weights, 1))
        sy = sum(v / (2 * k) * (at(y + k, x) - at(y - k, x)) for k, v in enumerate(weights, 1))
        length = np.sqrt(sx * sx + sy * sy + 1)
        assert (r, g, b, a) == pytest.approx((-sx / length, -sy / length, 1 / length, heights[y, x]))
