"""Shapes of physical plans that matter at scale."""

import pytest
from pyspark.sql import functions as F

from texelframe.operators import metrics, pairs, resample, samples, stencil, stitch, tiles
from texelframe.plans import compare, convert
from texelframe.plans import pyramid as pyramids
from texelframe.sources import tables
from workload import fixtures as fx
from workload.queries import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    text = plan(df)
    return text.count("Exchange hashpartitioning") + text.count("Exchange rangepartitioning") + text.count("Exchange SinglePartition")


@pytest.fixture
def sized(spark, folder):
    return fx.px(spark, folder).withColumns({"width": F.lit(16), "height": F.lit(16)})


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith("p") and not n.startswith(("p16", "p17"))])
def test_sample_operators_do_not_shuffle(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    assert "Python" not in text
    # the 4x4 fixture itself is an aggregate over the vectors
    assert "Exchange" not in text or "embeddings.parquet" in text


@pytest.mark.parametrize("name", ["triangle", "mitchell", "kaiser"])
def test_two_filter_passes_share_one_exchange(sized, name):
    assert exchanges(resample.next_mip(sized, name)) == 1


def test_a_task_gathers_tiles_not_the_sums_of_a_filter(spark):
    """Of 100 images of 64 samples, 143 resized, no aggregate holds more than a row each; samples are exchanged once."""
    p = F.col("id") % 64
    maps = spark.range(0, 6400, 1, 4).select(
        F.floor(F.col("id") / 64).alias("texture_id"), F.floor(p / 8).cast("int").alias("y"), (p % 8).cast("int").alias("x"),
        F.rand(1).alias("a"), F.lit(8).alias("width"), F.lit(8).alias("height"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = resample._resize_by_tile(maps.withColumns({"out_w": F.lit(13), "out_h": F.lit(11)}), "mitchell", "clamp")
        nodes, gathered, sent = [out._jdf.queryExecution().executedPlan()], [], []
        rows = len(out.collect())
        while nodes:
            node = nodes.pop()
            nodes += [node.children().apply(k) for k in range(node.children().size())]
            if "Aggregate" in node.nodeName():
                gathered.append(node.metrics().apply("numOutputRows").value())
            if "Exchange" in node.nodeName():
                sent.append(node.metrics().apply("shuffleRecordsWritten").value())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert rows == 100 * 13 * 11
    assert gathered and max(gathered) == 100 and sent == [6400]


def test_a_thumbnail_is_made_under_many_keys_from_combined_sums(spark):
    """Neither its samples nor its sums meet in one task, and few rows are exchanged."""
    x, y = (F.col("id") % 256).cast("int"), F.floor(F.col("id") / 256).cast("int")
    big = spark.range(0, 256 * 256, 1, 4).select(
        F.lit(1).alias("texture_id"), y.alias("y"), x.alias("x"), F.rand(1).alias("r"), F.lit(256).alias("width"), F.lit(256).alias("height")
    )
    thumb = resample.resize(big, 16, 16, "kaiser")
    assert "Python" not in plan(thumb) and "partial_sum" in plan(thumb)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        sums = resample._resize_by_sums(big.withColumns({"out_w": F.lit(16), "out_h": F.lit(16)}), "kaiser", "clamp", "xy")
        per_task = [r["count"] for r in sums.groupBy(F.spark_partition_id()).count().collect()]
        dealt = sums._jdf.queryExecution().executedPlan()
        written, nodes = [], [dealt]
        sums.collect()
        while nodes:
            node = nodes.pop()
            nodes += [node.children().apply(k) for k in range(node.children().size())]
            if "Exchange" in node.nodeName():
                written.append(node.metrics().apply("shuffleRecordsWritten").value())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(per_task) > 10 and sum(per_task) == 256  # one image, many keys
    assert len(written) == 2 and sum(written) < 256 * 256 / 4


def test_other_neighbourhood_work_takes_one_exchange(sized):
    assert exchanges(resample.next_mip(sized, "box")) == 1
    assert exchanges(resample.next_mip(sized, "max")) == 1
    assert exchanges(stencil.color_to_normal(sized)) == 1
    assert exchanges(tiles.block_quantize(sized)) == 1
    assert exchanges(tiles.tile_stats(sized)) == 1


def test_nested_pyramid_takes_two_exchanges_for_all_levels(sized):
    levels = pyramids.pyramid(sized)
    levels.collect()  # the levels' branches share exchanges once the plan is final
    final = levels._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") - final.count("ReusedExchange") == 2


def test_pair_and_report_place_each_side_once(spark, sized):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        other = samples.quantize_unorm(sized, 4)
        assert exchanges(metrics.diff_report(pairs.pair(sized, other))) == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("axis, last", [("x", 65535), ("z", 40)])
def test_per_image_values_reach_strips_and_volumes_under_many_keys(spark, axis, last):
    """One image, a single row high: its samples still meet their value in many tasks."""
    keys = {c: F.lit(0) for c in "zyx"} | {axis: F.col("id").cast("int")}
    df = spark.range(last + 1).select(F.lit(1).alias("texture_id"), *[v.alias(c) for c, v in keys.items()], *[(F.col("id") / last).alias(c) for c in "rgba"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        scaled = metrics.range_scale(df)
        tasks = scaled.groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert scaled.filter(f"abs(r - {axis} / {last}) > 1e-12").count() == 0
    finally:
        for name in ("sql.autoBroadcastJoinThreshold", "sql.adaptive.enabled"):
            spark.conf.unset(f"spark.{name}")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(tasks) > 5 and sum(r["count"] for r in tasks) == last + 1


def test_a_stencil_sends_each_sample_at_most_twice(spark):
    x, y = (F.col("id") % 256).cast("int"), F.floor(F.col("id") / 256).cast("int")
    df = spark.range(256 * 256).select(F.lit(1).alias("texture_id"), y.alias("y"), x.alias("x"), F.rand(1).alias("a"), F.lit(256).alias("width"), F.lit(256).alias("height"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        normals = stencil.to_normal_map(df, 1.0, 1.0, 1.0, 1.0)
        nodes, rows = [normals._jdf.queryExecution().executedPlan()], []
        assert normals.collect()
        while nodes:
            node = nodes.pop()
            nodes += [node.children().apply(k) for k in range(node.children().size())]
            if "Exchange" in node.nodeName():
                rows.append(node.metrics().apply("shuffleRecordsWritten").value())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(rows) == 1 and rows[0] <= 2 * 256 * 256


def test_scaled_comparisons_are_paired_once(spark, sized):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = plan(compare.compare_images(sized, samples.quantize_unorm(sized, 4), rangescale=True))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert report.count("FullOuter") == 1


def test_stored_tables_are_paired_where_they_lie(spark, sized, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, df in (("ours", sized), ("theirs", samples.quantize_unorm(sized, 4))):
            tables.store_samples(df, name, 6, str(tmp_path / name))
        ours, theirs = (tables.stored_samples(spark, name) for name in ("ours", "theirs"))
        for how in ("inner", "full"):
            assert exchanges(pairs.pair(ours, theirs, how)) == 0
        assert exchanges(pairs.copy_channel_from(ours, theirs, "r", "a")) == 0
        assert exchanges(pairs.add_channel(ours, theirs, "r", "a")) == 0
        assert exchanges(compare.compare_images(ours, theirs)) == 1  # partial sums by image
        assert pairs.pair(ours, theirs).count() == sized.count()
        assert len(list((tmp_path / "ours").glob("part-*"))) == 6
    finally:
        spark.sql("DROP TABLE IF EXISTS ours")
        spark.sql("DROP TABLE IF EXISTS theirs")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_report_is_one_aggregate(spark, folder):
    text = plan(metrics.diff_report(fx.px_pair(spark, folder), normals=True))
    assert text.count("HashAggregate") == 2 and "Python" not in text


def test_kernel_code_stays_below_the_compile_limit(spark, sized):
    """Methods over 8000 bytes of code run interpreted, many times slower."""
    import re

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = resample.next_mip(samples.to_linear_from_srgb_unclamped(sized.withColumn("mip", F.lit(0))), "kaiser")
        debug = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$")
        code = debug.codegenString(df._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000


def test_a_mixed_conversion_is_one_plan_without_python(spark, folder):
    """Formats are a CASE in generated code; one format's literal leaves nothing of the others."""
    mixed = convert.convert_mixed(fx.px(spark, folder), fx.px_textures(spark, folder))
    assert "Python" not in plan(mixed) and "Cartesian" not in plan(mixed)
    source = plan(fx.px(spark, folder)).count("CASE WHEN")
    assert plan(convert.quantize_for_format(fx.px(spark, folder), "bc7")).count("CASE WHEN") == source


def test_what_is_made_of_an_image_is_made_once(spark, folder):
    """The levels of a changed image read a stored table, not the changes above it."""
    out = convert.convert(fx.px(spark, folder), rgbm=True, rangescale=True)
    assert "events.parquet" not in plan(out) and "stored-" in plan(out)


def test_part_names_are_matched_once(spark, folder):
    parsed = stitch.parse_parts(fx.parts(spark, folder).select("file"))
    assert plan(parsed).count("regexp_replace") == 1
    assert plan(stitch.part_name_errors(fx.parts(spark, folder).select("file"))).count("regexp_replace") == 1


def test_stitch_moves_words_and_joins_once(spark, folder):
    """Parts are exchanged for their words, for first files, and for one join with them; all else is smaller."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = fx.file_parts(spark, folder)
        # words, blocks, bases
        assert exchanges(stitch.stitch_extent(parts)) == 3
        # and first files, parts and first files by band
        assert exchanges(stitch.stitch_errors(parts)) == 6
        for df in (stitch.stitch_extent(parts), stitch.stitch_errors(parts), stitch.stitch_missing(parts), stitch.stitch_clean(parts)):
            assert "Python" not in plan(df) and "LeftAnti" not in plan(df)
        assert plan(stitch.stitch_missing(parts)).count("SortMergeJoin") == 3  # extents and firsts, and theirs with parts
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_catalogue_reads_only_its_columns(spark, folder):
    text = plan(tables.catalog_summary(fx.textures(spark, folder)))
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in text


def test_operators_apply_to_streams(spark, folder, tmp_path):
    """Per-sample operators are plain projections and take a stream as it is."""
    batch = fx.px(spark, folder)
    path = str(tmp_path / "in")
    batch.write.parquet(path)
    stream = spark.readStream.schema(batch.schema).parquet(path)
    out = samples.to_rgbm(samples.to_srgb_unclamped(samples.tone_map_linear(stream)))
    query = out.writeStream.format("memory").queryName("stream_out").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    expected = samples.to_rgbm(samples.to_srgb_unclamped(samples.tone_map_linear(batch)))
    assert spark.table("stream_out").exceptAll(expected).count() == 0
    assert spark.table("stream_out").count() == batch.count()
