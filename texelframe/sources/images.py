"""Samples from raw interleaved buffers and from decoded image files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from texelframe.schema import CHANNELS
from texelframe.session import cut_lineage

# Fixed value: images arrive with their bytes in blue, green, red, alpha order.
BGRA = "bgra"


def explode_raw(
    df: DataFrame,
    width: Column | int,
    height: Column | int,
    channels: Column | int = 4,
    order: str = BGRA,
    content: str = "content",
    spread: bool = True,
    keep_empty: bool = False,
) -> DataFrame:
    """One row per sample of 8-bit interleaved buffers, values scaled to [0, 1].

    ``order`` names the channel each byte of a sample holds; channels it does not
    name are 0, a missing alpha is 1. Buffers are cut to lines first, then lines
    are spread over tasks, so one huge buffer does not stay in one task and no
    buffer is copied per sample. A line is decoded once, to an array of its bytes. Other columns are kept. An image without
    a line has no row, or one without samples with ``keep_empty``.
    """
    def as_column(v: Column | int) -> Column:
        return (v if isinstance(v, Column) else F.lit(v)).cast("int")

    def places(size: str) -> Column:
        """One row for each place along a side."""
        inside = F.when(F.col(size) > 0, F.sequence(F.lit(0), F.col(size) - 1))
        return F.explode_outer(inside) if keep_empty else F.explode(inside)

    kept = [c for c in df.columns if c not in (content, "width", "height")]
    sized = df.withColumns(
        {"width": as_column(width), "height": as_column(height), "_n": as_column(channels), "_buffer": F.monotonically_increasing_id()}
    )
    lines = sized.select(*kept, "width", "height", "_n", "_buffer", content, places("height").alias("y"))
    stride = F.col("width") * F.col("_n")
    lines = lines.withColumn("_line", F.substring(F.col(content), F.col("y") * stride + 1, stride)).drop(content)
    if spread:
        # by buffer and line, whatever is in it: blank images are no hot key
        name = next((c for c in ("texture_id", "path") if c in kept), "_buffer")
        lines = lines.repartition(name, "y")
    # a character for each byte; the array is made before samples are, once a line
    lines = lines.withColumn("_bytes", F.split(F.decode("_line", "ISO-8859-1"), "")).drop("_line", "_buffer")
    dots = lines.select(*kept, "width", "height", "_n", "y", "_bytes", places("width").alias("x"))

    def byte(k: int) -> Column:
        return F.ascii(F.get("_bytes", F.col("x") * F.col("_n") + k)).cast("double") / 255

    absent = {"r": 0.0, "g": 0.0, "b": 0.0, "a": 1.0}
    values = {
        c: F.when(F.col("x").isNull(), F.lit(None).cast("double"))
        .when(F.col("_n") > order.index(c), byte(order.index(c))).otherwise(absent[c])
        if c in order
        else F.lit(absent[c])
        for c in CHANNELS
    }
    return dots.select(*kept, "width", "height", "y", "x", *[v.alias(c) for c, v in values.items()])


def decode_fault() -> Column:
    """Why an image of an image-source table has no samples: decode, size (its bytes are not those of its size), or null."""
    n_bytes = F.col("image.width").cast("bigint") * F.col("image.height") * F.col("image.nChannels")
    unread = F.col("image.data").isNull() | (F.length("image.data") == 0) | (F.col("image.nChannels") <= 0)
    return F.when(F.coalesce(unread, F.lit(True)), "decode").when(F.length("image.data") != n_bytes, "size")


def checked_samples(images: DataFrame) -> DataFrame:
    """Samples of an image-source table (struct column ``image``), and one row for each image that has none.

    ``code`` is null in samples and says in the other rows why there are none; these have no
    coordinates and channels. One-channel images are grey: their value goes to r, g and b.
    """
    rows = images.withColumns({"code": decode_fault(), "_grey": F.col("image.nChannels") == 1, "content": F.col("image.data")})
    side = lambda c: F.when(F.col("code").isNull(), F.col(f"image.{c}")).otherwise(0)
    out = explode_raw(rows, side("width"), side("height"), F.col("image.nChannels"), keep_empty=True)
    grey = {c: F.when(F.col("_grey"), F.col("b")).otherwise(F.col(c)) for c in ("r", "g")}
    return out.withColumns(grey).drop("image", "_grey")


def image_samples(images: DataFrame) -> DataFrame:
    """The samples of checked_samples alone."""
    return checked_samples(images.filter(decode_fault().isNull())).drop("code")


def _read(spark: SparkSession, folder: str) -> DataFrame:
    """All files of a folder that are not empty, decoded or not."""
    images = spark.read.format("image").option("dropInvalid", False).load(folder)
    return images.withColumn("path", F.col("image.origin")).withColumn("texture_id", F.xxhash64("path"))


def scan_images(spark: SparkSession, folder: str) -> DataFrame:
    """Samples of all images in a folder, with the path of their file.

    texture_id is derived from the path and stable across runs. Files that could not
    be decoded have no samples; scan_with_faults names them.
    """
    return image_samples(_read(spark, folder))


def scan_with_faults(spark: SparkSession, folder: str, observation: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """Samples of all images in a folder, and (path, code) of the files that have none, from one read.

    Both come from a table that the scan writes once. Files without a byte, which Spark's readers pass over,
    are those of its listing that are not in that table. An ``observation`` gets the
    numbers of samples, images and undecodable files as the table is written.
    """
    read = _read(spark, folder)
    rows = checked_samples(read)
    if observation is not None:
        first = F.col("x").isNull() | ((F.col("x") == 0) & (F.col("y") == 0))
        rows = rows.observe(
            observation, F.count("x").alias("n_samples"), F.count(F.when(first & F.col("code").isNull(), 1)).alias("n_images"), F.count("code").alias("n_faults")
        )
    stored = cut_lineage(rows)
    faults = stored.filter("code IS NOT NULL").select("path", "code")
    # the driver holds the listing in any case
    listed = spark.createDataFrame([(path,) for path in read.inputFiles()], "path string")
    empty = listed.join(stored.select("path").distinct(), "path", "left_anti").withColumn("code", F.lit("empty"))
    return stored.filter("code IS NULL").drop("code"), faults.unionByName(empty)


def image_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Files of a folder that could not be decoded, as (path, code); samples are not made."""
    return _read(spark, folder).withColumn("code", decode_fault()).filter("code IS NOT NULL").select("path", "code")
