"""Texture tables derived from the test tables, always over all their rows.

Each function has a CTE of the same name in ``workload.sql``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from texelframe.operators.samples import quantize_unorm
from texelframe.operators.stitch import parse_parts, resolve_part_names
from texelframe.session import cut_lineage


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _floor(c: Column, kind: str) -> Column:
    return F.floor(c).cast(kind)


def px(spark: SparkSession, folder: str) -> DataFrame:
    """RGBA samples, 16 wide, at most 16 high; red is HDR, alpha includes 0."""
    event = F.col("event_id")
    return table(spark, folder, "events").select(
        _floor(event / 256, "bigint").alias("texture_id"),
        _floor(event % 256 / 16, "int").alias("y"),
        (event % 16).cast("int").alias("x"),
        (F.col("value") / 16).alias("r"),
        (F.col("user_id") / 149).alias("g"),
        (F.hour("ts") / 23).alias("b"),
        (F.regexp_extract("props", "([0-9]+)", 1).cast("int") / 99).alias("a"),
    )


FORMATS = ("bc7", "bc1a", "bc2", "bc5s", "bc6", "lumi", "bc3_rgbm", "rgb", "astc_ldr_4x4", "nonsense")


def px_textures(spark: SparkSession, folder: str) -> DataFrame:
    """A row per image with its target format and all that may go with one."""
    sized = px(spark, folder).groupBy("texture_id").agg((F.max("x") + 1).alias("width"), (F.max("y") + 1).alias("height"))
    t = F.col("texture_id")
    return sized.withColumns({
        "format": F.element_at(F.array(*map(F.lit, FORMATS)), (t % len(FORMATS) + 1).cast("int")),
        "alpha_mode": F.when(t % 3 == 0, "premultiplied").otherwise("transparency"),
        "alpha": F.when(t % 4 == 1, True).when(t % 4 == 2, False),
        "alpha_dithering": t % 4 < 3,
        "alpha_bits": F.when(t % 5 == 2, 3).when(t % 50 == 1, 9).cast("int"),
        "rgbm": t % 20 == 8,
    })


def px_low(spark: SparkSession, folder: str) -> DataFrame:
    """The same images at 4 bits per channel."""
    return quantize_unorm(px(spark, folder), 4)


def px_pair(spark: SparkSession, folder: str) -> DataFrame:
    low = {c + "2": F.col("_low." + c) for c in "rgba"}
    base = px(spark, folder).withColumn("_high", F.struct("r", "g", "b", "a"))
    both = quantize_unorm(base, 4).withColumn("_low", F.struct("r", "g", "b", "a"))
    return both.withColumns({**{c: F.col("_high." + c) for c in "rgba"}, **low}).drop("_high", "_low")


def unit_values(spark: SparkSession, folder: str) -> DataFrame:
    """Vector components moved to around 0.5, one row each."""
    return table(spark, folder, "embeddings").select("vec_id", F.posexplode("embedding").alias("p", "v")).withColumn(
        "v", F.col("v").cast("double") * 0.5 + 0.5
    )


def hm(spark: SparkSession, folder: str) -> DataFrame:
    """8x8 height maps."""
    return unit_values(spark, folder).select(
        F.col("vec_id").alias("texture_id"),
        _floor(F.col("p") / 8, "int").alias("y"),
        (F.col("p") % 8).alias("x"),
        F.col("v").alias("h"),
    )


def hm_alpha(spark: SparkSession, folder: str) -> DataFrame:
    return hm(spark, folder).withColumnRenamed("h", "a")


def px4(spark: SparkSession, folder: str) -> DataFrame:
    """4x4 RGBA images."""
    picked = {c: F.max(F.when(F.col("p") % 4 == i, F.col("v"))).alias(c) for i, c in enumerate("rgba")}
    return unit_values(spark, folder).groupBy(
        F.col("vec_id").alias("texture_id"),
        _floor(F.col("p") / 16, "int").alias("y"),
        _floor(F.col("p") % 16 / 4, "int").alias("x"),
    ).agg(*picked.values())


def raw_buffers(spark: SparkSession, folder: str) -> DataFrame:
    """4x4 images as interleaved 8-bit buffers, built from the vectors."""
    def as_hex(v: Column) -> Column:
        level = F.floor((v.cast("double") * 0.5 + 0.5) * 255 + 0.5).cast("int")
        return F.lpad(F.hex(level), 2, "0")

    content = F.unhex(F.array_join(F.transform("embedding", as_hex), ""))
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("texture_id"), content.alias("content"))


def image_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The same images in the layout of Spark's image source."""
    image = F.struct(
        F.lit("").alias("origin"), F.lit(4).alias("height"), F.lit(4).alias("width"),
        F.lit(4).alias("nChannels"), F.lit(24).alias("mode"), F.col("content").alias("data"),
    )
    return raw_buffers(spark, folder).select("texture_id", image.alias("image"))


def broken_image_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The same, some of them cut short, without data or with no channels."""
    key, whole = F.col("texture_id"), F.col("image")
    data = F.when(key % 5 == 1, F.substring("image.data", 1, 60)).when(key % 7 != 2, F.col("image.data"))
    broken = whole.withField("data", data).withField("nChannels", F.when(key % 11 == 3, -1).otherwise(F.col("image.nChannels")))
    return image_rows(spark, folder).withColumn("image", broken)


def files(spark: SparkSession, folder: str) -> DataFrame:
    """A listing with tags in the names, 20 folders."""
    doc = F.col("doc_id")
    tag = F.when(doc % 5 == 0, "_rgbm").when(doc % 5 == 1, "_bc3n").when(doc % 5 == 2, "_bc6").otherwise("")
    kind = F.when(doc % 3 == 0, ".dds").when(doc % 3 == 1, ".png").otherwise(".tga")
    return table(spark, folder, "documents").select(
        "doc_id",
        F.col("source").alias("dir"),
        F.concat(F.lit("tex"), doc.cast("string"), tag, kind).alias("name"),
        F.col("n_chars").alias("n_bytes"),
    )


def contents(spark: SparkSession, folder: str) -> DataFrame:
    """Document bytes; a third of them begin like a texture container."""
    start = F.when(F.col("doc_id") % 3 == 0, "DDS ").otherwise("")
    return table(spark, folder, "documents").select(
        "doc_id", F.concat(start, F.col("text")).cast("binary").alias("content")
    )


def parts(spark: SparkSession, folder: str) -> DataFrame:
    """Single-part files of 2 layers x 4 faces x 3 mips, some with wrong headers."""
    k = F.col("o_orderkey")
    base = table(spark, folder, "orders").select(
        k.alias("k"),
        _floor(k / 24, "bigint").alias("texture_id"),
        _floor(k % 24 / 12, "int").alias("layer"),
        _floor(k % 12 / 3, "int").alias("face"),
        (k % 3).cast("int").alias("mip"),
    )
    full = F.call_function("shiftright", F.lit(64), F.col("mip"))
    width = F.when(F.col("k") % 89 == 5, 48).otherwise(full)
    mark = F.when(F.col("k") % 2 == 0, "_M").otherwise("_")
    return base.select(
        "k", "texture_id", "layer", "face", "mip",
        width.alias("width"),
        F.when(F.col("k") % 97 == 7, "bc1").otherwise("bc7").alias("format"),
        F.when(F.col("k") % 101 == 9, "premultiplied").otherwise("straight").alias("alpha_mode"),
        F.format_string("t%d_L%d_F%d%s%d.dds", "texture_id", "layer", "face", mark, "mip").alias("file"),
    )


def parts_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """The same files, some of them missing: what stitching has to notice."""
    return parts(spark, folder).filter(F.col("k") % 83 != 11)


def file_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The files with gaps as stitch reads them: places from the names, headers attached.

    Parsed once and stored, as every check reads the table several times.
    """
    named = parts_gaps(spark, folder).select("file", "width", "format", "alpha_mode")
    placed = resolve_part_names(parse_parts(named))
    one, zero = F.lit(1), F.lit(0)
    headed = placed.withColumns(
        {
            "n_layers": one, "n_faces": one, "n_mips": one, "height": F.col("width"), "depth": one,
            "color_transform": F.lit("none"), "layer": zero, "face": zero, "mip": zero,
        }
    )
    return cut_lineage(headed)


def whole(spark: SparkSession, folder: str) -> DataFrame:
    """The parts as subresources of whole textures."""
    return parts(spark, folder).select(
        "texture_id", "layer", "face", "mip", F.lit(2).alias("n_layers"), F.lit(4).alias("n_faces"),
        F.lit(3).alias("n_mips"), F.lit(64).alias("mip0_width"), F.lit(64).alias("mip0_height"),
    )


def textures(spark: SparkSession, folder: str) -> DataFrame:
    """Odd, non-square and tiny sizes in four formats."""
    key = F.col("p_partkey")
    kind = F.when(key % 4 == 0, "bc1").when(key % 4 == 1, "bc7").when(key % 4 == 2, "astc_ldr_6x5").otherwise("bc4")
    return table(spark, folder, "part").select(
        key.alias("texture_id"),
        (F.col("p_size") * 13 + key % 7).cast("int").alias("width"),
        (F.col("p_size") * 5 + key % 11 + 1).cast("int").alias("height"),
        F.lit(1).alias("depth"),
        kind.alias("format"),
    )
