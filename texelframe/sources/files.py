"""File listings and output naming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from texelframe.functions.names import is_container, replace_extension


def scan_files(spark: SparkSession, folder: str, with_magic: bool = False) -> DataFrame:
    """Regular files directly inside a folder, with sizes.

    Contents are not read unless ``with_magic`` asks whether each file is a
    texture container.
    """
    listed = spark.read.format("binaryFile").load(folder)
    columns = [
        F.col("path"),
        F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("dir"),
        F.regexp_extract("path", r"[^/]*$", 0).alias("name"),
        F.col("length").alias("n_bytes"),
    ]
    if with_magic:
        columns.append(is_container(F.col("content")).alias("is_container"))
    return listed.select(*columns)


def with_output_path(files: DataFrame, extension: str = ".dds", out_dir: Column | None = None) -> DataFrame:
    """Add ``out_path``: same name, new extension.

    Without ``out_dir`` outputs go to ``<dir>_out``. An output that would replace
    its own input gets ``_out`` before the extension.
    """
    source = F.concat_ws("/", "dir", "name")
    folder = F.concat(F.col("dir"), F.lit("_out")) if out_dir is None else out_dir
    target = F.concat_ws("/", folder, replace_extension(F.col("name"), extension))
    renamed = F.concat_ws("/", folder, replace_extension(F.col("name"), "_out" + extension))
    return files.withColumn("out_path", F.when(target == source, renamed).otherwise(target))


def scan_report(expected: DataFrame, scanned: DataFrame, faults: DataFrame | None = None) -> DataFrame:
    """Expected paths that could not be read or were empty, one row each.

    With ``faults``, (path, code) of files that were read but not understood, these are
    part of the report and every row says why it is there: the fault's code, ``empty`` or ``missing``.
    """
    if faults is None:
        readable = scanned.filter(F.col("n_bytes") > 0).select("path")
        return expected.select("path").join(readable, "path", "left_anti")
    # a path's listing and its faults meet in one aggregate
    each = (
        expected.select("path", F.lit(None).cast("bigint").alias("n_bytes"), F.lit(None).cast("string").alias("code"), F.lit(True).alias("wanted"))
        .unionByName(scanned.select("path", F.col("n_bytes").cast("bigint").alias("n_bytes"), F.lit(None).cast("string").alias("code"), F.lit(False).alias("wanted")))
        .unionByName(faults.select("path", F.lit(None).cast("bigint").alias("n_bytes"), "code", F.lit(False).alias("wanted")))
    )
    found = each.groupBy("path").agg(F.max("n_bytes").alias("n_bytes"), F.max("code").alias("code"), F.bool_or("wanted").alias("wanted"))
    code = F.when(F.coalesce("n_bytes", F.lit(0)) == 0, F.when(F.col("n_bytes").isNull() & F.col("code").isNull(), "missing").otherwise(F.coalesce("code", F.lit("empty"))))
    return found.filter("wanted").select("path", F.coalesce("code", code).alias("code")).filter("code IS NOT NULL")


def raw_size_check(files: DataFrame, channels: int = 4) -> DataFrame:
    """Raw files whose length is not width * height * channels bytes."""
    expected = F.col("width").cast("bigint") * F.col("height") * channels
    return files.withColumn("expected_bytes", expected).filter(F.col("n_bytes") != F.col("expected_bytes"))
