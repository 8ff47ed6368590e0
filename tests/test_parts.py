"""Splitting, joining and batching."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from texelframe.operators import batches, detach, stitch
from texelframe.operators.placement import wrap
from texelframe.schema import with_default_keys


def whole(spark, n_layers=2, n_faces=3, n_mips=4):
    rows = [
        (7, l, f, m, n_layers, n_faces, n_mips, 40, 24)
        for l in range(n_layers) for f in range(n_faces) for m in range(n_mips)
    ]
    return spark.createDataFrame(
        rows,
        "texture_id long, layer int, face int, mip int, n_layers int, n_faces int, n_mips int,"
        " mip0_width int, mip0_height int",
    )


def as_parts(detached):
    """Split files as stitch reads them."""
    return detached.withColumnsRenamed({"mip0_width": "width", "mip0_height": "height"}).withColumns(
        {"base": F.lit("7"), "depth": F.lit(1), "format": F.lit("bc7"), "alpha_mode": F.lit("straight"), "color_transform": F.lit("none")}
    )


AXES = [c for n in range(4) for c in itertools.combinations(detach.AXES, n)]


@pytest.mark.parametrize("axes", AXES)
def test_stitch_undoes_detach(spark, axes):
    parts = as_parts(detach.detach(whole(spark), axes))
    assert stitch.stitch_faults(parts).count() == 0
    joined = {(r.layer, r.face, r.mip) for r in stitch.stitch(parts).collect()}
    assert joined == {(r.layer, r.face, r.mip) for r in whole(spark).collect()}


@pytest.mark.parametrize("axes", AXES)
def test_names_parse_back(spark, axes):
    axes = axes or ("mip",)
    files = detach.detach(whole(spark), axes).select("file", *stitch.FILE_KEYS).distinct()
    flags = {"layers": "layer" in axes, "faces": "face" in axes, "mips": "mip" in axes}
    parsed = stitch.parse_parts(files.select("file", *[F.col(k).alias("was_" + k) for k in stitch.FILE_KEYS]), **flags)
    assert parsed.count() == files.count()
    assert parsed.filter(" OR ".join(f"{k} <> was_{k}" for k in stitch.FILE_KEYS)).count() == 0


def test_unknown_axis_is_refused(spark):
    with pytest.raises(ValueError):
        detach.detach(whole(spark), ("slice",))


def test_cube_flags_drop_with_split_faces(spark):
    df = whole(spark).withColumn("cube_flags", F.lit(5))
    assert detach.detach_meta(df, ("face",)).first().cube_flags == 0
    assert detach.detach_meta(df, ("mip",)).first().cube_flags == 5


def test_m_name_wins_and_foreign_names_drop(spark):
    files = spark.createDataFrame([("t_M0.dds",), ("t_0.dds",), ("t_1.dds",), ("t_01.dds",), ("t.png",)], "file string")
    best = stitch.resolve_part_names(stitch.parse_parts(files, layers=False, faces=False)).collect()
    assert {(r.mip_file, r.file) for r in best} == {(0, "t_M0.dds"), (1, "t_1.dds")}


def test_whole_name_without_axes(spark):
    files = spark.createDataFrame([("wall.dds",)], "file string")
    row = stitch.parse_parts(files, layers=False, faces=False, mips=False).first()
    assert (row.base, row.layer_file, row.face_file, row.mip_file) == ("wall", 0, 0, 0)


def grid(spark, places, **header):
    fields = {
        "n_layers": 1, "n_faces": 1, "n_mips": 1, "width": 1, "height": 1, "depth": 1, "format": "bc7",
        "alpha_mode": "none", "color_transform": "none", "layer": 0, "face": 0, "mip": 0,
    } | header
    df = spark.createDataFrame(places, "base string, layer_file int, face_file int, mip_file int")
    return df.withColumn("file", F.concat_ws("_", *df.columns)).withColumns({k: F.lit(v) for k, v in fields.items()})


def test_extent_ends_at_first_gap(spark):
    places = [("t", 0, 0, m) for m in (0, 1, 3)] + [("u", 0, 0, 1)]
    rows = stitch.stitch_extent(grid(spark, places)).collect()
    assert [(r.base, r.layer_files, r.face_files, r.mip_files) for r in rows] == [("t", 1, 1, 2)]
    bases = spark.createDataFrame([("t",), ("u",), ("v",)], "base string")
    assert {r.base for r in stitch.stitch_empty(bases, grid(spark, places)).collect()} == {"u", "v"}
    assert stitch.stitch(grid(spark, places)).count() == 2


@pytest.mark.parametrize("n, gone", [(1, []), (31, []), (32, []), (33, []), (70, [31]), (70, [32]), (70, [63, 64]), (1024, []), (1025, [1024]), (3000, [1023]),
                                     (3000, [1024]), (3000, range(32, 64)), (5000, range(1024, 2048)), (5000, range(1024, 3072)), (2500, [0])])
def test_an_axis_ends_at_its_first_zero(spark, n, gone):
    places = [("t", i, 0, 0) for i in range(n) if i not in gone] + [("u", 0, 0, i) for i in range(n) if i not in gone]
    want = min(gone, default=n)
    got = {r.base: (r.layer_files, r.face_files, r.mip_files) for r in stitch.stitch_extent(grid(spark, places)).collect()}
    assert got == ({"t": (want, 1, 1), "u": (1, 1, want)} if want else {})


def test_missing_places_of_large_grids(spark):
    """Zeros in words, whole words, whole blocks and the last, shorter block; faces and mips beside layers."""
    gone = {(5, 1, 0), (699, 2, 1), (699, 1, 1)} | {(k, f, m) for k in range(300, 650) for f in range(3) for m in (0, 1) if (f, m) != (0, 0)}
    places = [("t", k, f, m) for k in range(700) for f in range(3) for m in (0, 1) if (k, f, m) not in gone]
    places += [("whole", k, 0, m) for k in range(40) for m in range(40)] + [("twice", 0, 0, 0), ("twice", 0, 0, 0), ("twice", 0, 1, 0), ("twice", 1, 0, 0)]
    rows = stitch.stitch_missing(grid(spark, places)).collect()
    assert len(rows) == len(gone) + 1
    assert {(r.layer_file, r.face_file, r.mip_file) for r in rows if r.base == "t"} == gone
    assert [(r.layer_file, r.face_file, r.mip_file) for r in rows if r.base == "twice"] == [(1, 1, 0)]
    assert {r.base for r in stitch.stitch_clean(grid(spark, places)).collect()} == {"whole"}


def test_clean_bases_are_those_without_a_fault_row(spark):
    rng = np.random.default_rng(3)
    parts = None
    for k in range(25):
        places = [(f"b{k}", x, y, z) for x in range(3) for y in range(2) for z in range(2) if rng.random() > 0.02]
        header = [{}, {}, {"format": "bc1"}, {"n_faces": 4}][k % 4]
        more = grid(spark, places, **({} if k % 4 == 2 else header))
        if k % 4 == 2:  # one file of another format
            more = more.withColumn("format", F.when((F.col("layer_file") == 1) & (F.col("mip_file") == k % 3), "bc1").otherwise("bc7"))
        parts = more if parts is None else parts.unionByName(more)
    parts = parts.cache()
    faulty = {r.base for r in stitch.stitch_faults(parts).collect()}
    every = {r.base for r in stitch.stitch_extent(parts).collect()}
    assert faulty and every - faulty
    assert {r.base for r in stitch.stitch_clean(parts).collect()} == every - faulty


def test_one_base_with_very_many_layers(spark):
    """Bands, grid blocks and the missing report over a single huge base."""
    n = 10_000
    layers = spark.range(n).select(
        F.lit("t").alias("base"), F.col("id").cast("int").alias("layer_file"), F.lit(0).alias("face_file"),
        F.explode(F.array(F.lit(0), F.lit(1))).alias("mip_file"),
    ).filter("NOT (layer_file IN (4321, 9999) AND mip_file = 1)")
    parts = layers.withColumn("file", F.lit("f")).withColumns(
        {c: F.lit(1) for c in ("n_layers", "n_faces", "n_mips", "width", "height", "depth")}
        | {c: F.lit("x") for c in ("format", "alpha_mode", "color_transform")}
        | {c: F.lit(0) for c in ("layer", "face", "mip")}
    )
    missing = {(r.layer_file, r.face_file, r.mip_file) for r in stitch.stitch_missing(parts).collect()}
    assert missing == {(4321, 0, 1), (9999, 0, 1)}


def test_fault_codes(spark):
    first = grid(spark, [("t", 0, 0, 0)], width=8, height=4)
    small = grid(spark, [("t", 0, 0, 1)], width=4, height=2)
    assert stitch.stitch_errors(first.unionByName(small)).count() == 0
    wrong = grid(spark, [("t", 0, 0, 1)], width=4, height=4, format="bc1", alpha_mode="straight", color_transform="luma", n_faces=2)
    codes = [r.code for r in stitch.stitch_errors(first.unionByName(wrong)).collect()]
    assert sorted(codes) == ["alpha_mode", "color_transform", "counts", "format", "size"]


def test_limits(spark):
    parts = grid(spark, [("t", l, f, 0) for l in (0, 1) for f in (0, 1)], n_layers=2**31 - 1, n_faces=4)
    found = {(r.code, r.total) for r in stitch.stitch_limits(parts).collect()}
    assert found == {("too_many_faces", 8)}
    more = grid(spark, [("t", l, 0, 0) for l in range(3)], n_layers=2**31 - 1)
    assert {r.code for r in stitch.stitch_limits(more).collect()} == {"too_many_layers"}


def greedy(sizes, max_bytes, max_files):
    out, batch, used, count = [], 0, 0, 0
    for size in sizes:
        if count and (used + size > max_bytes or count >= max_files):
            batch, used, count = batch + 1, 0, 0
        out.append(batch)
        used, count = used + size, count + 1
    return out


@pytest.mark.parametrize("max_bytes, max_files", [(1000, 7), (50, 3), (10**9, 5), (1, 4)])
def test_batches_equal_the_sequential_walk(spark, max_bytes, max_files):
    """One folder holds most files, and chunks are far smaller than folders."""
    rng = np.random.default_rng(3)
    rows = []
    for folder, n in (("hot", 500), ("small", 9), ("one", 1)):
        sizes = rng.integers(0, 400, n)
        rows += [(folder, i, int(s)) for i, s in enumerate(sizes)]
    files = spark.createDataFrame(rows, "dir string, path int, n_bytes long").repartition(3)
    got = batches.assign_batches(files, max_bytes, max_files, chunk_files=20).toPandas().sort_values(["dir", "path"])
    for folder, mine in got.groupby("dir"):
        assert mine.batch_id.tolist() == greedy(mine.n_bytes.tolist(), max_bytes, max_files), folder
    report = batches.batch_report(spark.createDataFrame(got))
    assert report.filter((F.col("n_files") > max_files) | ((F.col("total_bytes") > max_bytes) & (F.col("n_files") > 1))).count() == 0


def test_wrap_modes(spark):
    row = spark.range(1).select(*[wrap(F.lit(v), F.lit(4), m) for m in ("clamp", "repeat") for v in (-1, 5)]).first()
    assert tuple(row) == (0, 3, 3, 1)


def test_default_keys(spark):
    df = with_default_keys(spark.createDataFrame([(1, 0, 0, 0.5, 0.5, 0.5)], "texture_id long, y int, x int, r double, g double, b double"))
    row = df.first()
    assert (row.layer, row.face, row.mip, row.z, row.a) == (0, 0, 0, 0, 1.0)
