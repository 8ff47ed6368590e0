"""Sample tables on storage, plane extraction and the texture catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from texelframe.functions.names import plane_name, replace_extension
from texelframe.schema import sample_keys, with_default_keys


def write_pixels(df: DataFrame, path: str, mode: str = "errorifexists", rebalance: bool = False) -> None:
    """Store samples by face and level, so that reading a plane reads only its files.

    Many tasks holding a little of every plane write many small files; ``rebalance``
    spends an exchange to gather planes first. AQE splits the large ones, such as
    the base level with three quarters of all samples, back into even files.
    """
    df = with_default_keys(df)
    if rebalance:
        df = df.hint("rebalance", "face", "mip")
    df.write.mode(mode).partitionBy("face", "mip").parquet(path)


def read_pixels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def store_samples(df: DataFrame, name: str, buckets: int, path: str | None = None, mode: str = "errorifexists") -> None:
    """Store samples as a table in buckets by sample key, for joins with tables stored alike.

    Two tables of as many buckets and the same keys are paired without moving a sample: pair, channel
    exchange and comparisons read bucket by bucket. All sample keys make the bucket, so that buckets are
    even whatever the images' sizes; a bucket is one file. Without ``path`` the files are in the warehouse.
    """
    keys = sample_keys(df)
    writer = df.repartition(buckets, *keys).write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def stored_samples(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def extract_planes(
    df: DataFrame, path: Column, faces: bool = False, mips: bool = False, extension: str = ".tga"
) -> DataFrame:
    """Samples of the wanted planes with the name of the image each belongs to.

    Without ``faces`` only face 0 is taken, without ``mips`` only mip 0, and the
    name then leaves that part out.
    """
    if not faces:
        df = df.filter(F.col("face") == 0)
    if not mips:
        df = df.filter(F.col("mip") == 0)
    base = replace_extension(path, "")
    name = plane_name(base, F.col("face") if faces else None, F.col("mip") if mips else None, extension)
    return df.withColumn("out_name", name)


def catalog(textures: DataFrame) -> DataFrame:
    """Header fields of every texture; nothing of the contents is read."""
    fields = (
        "texture_id", "path", "width", "height", "depth", "n_layers", "n_faces", "n_mips", "format",
        "dimension", "cube_flags", "alpha_mode", "color_transform", "is_normal", "user_version",
    )
    return textures.select(*[f for f in fields if f in textures.columns])


def catalog_summary(textures: DataFrame) -> DataFrame:
    """Texture counts and pixel sizes per format and size, with totals per format and overall."""
    pixels = F.col("width").cast("bigint") * F.col("height")
    return textures.rollup("format", "width", "height").agg(
        F.count(F.lit(1)).alias("n_textures"),
        F.sum(pixels).cast("bigint").alias("total_pixels"),
        F.max(pixels).alias("max_pixels"),
        F.grouping_id().cast("int").alias("level"),
    )
