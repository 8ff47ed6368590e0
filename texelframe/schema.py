"""Table layouts and the small helpers every operator shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

IMAGE_KEYS = ("texture_id", "layer", "face", "mip")
SAMPLE_KEYS = (*IMAGE_KEYS, "z", "y", "x")
CHANNELS = ("r", "g", "b", "a")
RGB = ("r", "g", "b")

PIXELS = T.StructType(
    [T.StructField("texture_id", T.LongType())]
    + [T.StructField(k, T.IntegerType()) for k in SAMPLE_KEYS[1:]]
    + [T.StructField(c, T.DoubleType()) for c in CHANNELS]
)

# Columns that are constant per image and ride along through levels where a table has them.
CARRIED = ("storage",)

# Samples of one image within the same block of slices, rows and columns share a join key, so
# that a huge image of any shape spreads over as many keys as it has blocks.
BLOCK = {"z": 1, "y": 16, "x": 4096}


def image_keys(df: DataFrame) -> list[str]:
    """Columns naming one image plane; absent keys mean a single layer, face or mip."""
    return [k for k in IMAGE_KEYS if k in df.columns]


def plane_keys(df: DataFrame) -> list[str]:
    """Image keys plus the depth slice: the unit 2-D neighbourhoods live in."""
    return image_keys(df) + [k for k in ("z",) if k in df.columns]


def carried(df: DataFrame) -> list[str]:
    return [c for c in CARRIED if c in df.columns]


def sample_keys(df: DataFrame) -> list[str]:
    return [k for k in SAMPLE_KEYS if k in df.columns]


def channels(df: DataFrame) -> list[str]:
    return [c for c in CHANNELS if c in df.columns]


def with_default_keys(df: DataFrame) -> DataFrame:
    """Add the missing sample keys as 0 and a missing alpha as 1."""
    missing = {k: F.lit(0) for k in SAMPLE_KEYS[1:] if k not in df.columns}
    if "a" not in df.columns:
        missing["a"] = F.lit(1.0)
    return df.withColumns(missing) if missing else df


def int_div(col: Column, n: Column | int) -> Column:
    """Floor division for non-negative integers, kept as INT."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.floor(col / n).cast("int")


def ceil_div(col: Column, n: Column | int) -> Column:
    n = n if isinstance(n, Column) else F.lit(n)
    return F.ceil(col / n).cast("int")


def image_stats(df: DataFrame, *aggregates: Column, keys: list[str] | None = None) -> DataFrame:
    """One row of aggregates per image (or other leading keys), for ``join_image_stats``."""
    last = [F.max(axis).alias(f"_last_{axis}") for axis in BLOCK if axis in df.columns]
    return df.groupBy(*(image_keys(df) if keys is None else keys)).agg(*last, *aggregates)


def join_image_stats(df: DataFrame, stats: DataFrame, keys: list[str] | None = None, how: str = "inner") -> DataFrame:
    """Add per-image values to every sample of the image.

    They are joined by image and block (see BLOCK), so no image, however large, meets its
    samples under a single key; each image repeats its short row once per block. ``stats`` says how far
    an image goes, by its largest coordinates ``_last_z``, ``_last_y`` and ``_last_x``; samples beyond have no
    values, and drop out unless ``how`` is left.
    """
    keys = image_keys(df) if keys is None else keys
    per_block, placed, blocks = stats, df, []
    for axis, size in BLOCK.items():
        if f"_last_{axis}" in stats.columns and axis in df.columns:
            blocks.append(f"_block_{axis}")
            per_block = per_block.withColumn(blocks[-1], F.explode(F.sequence(F.lit(0), int_div(F.col(f"_last_{axis}"), size))))
            placed = placed.withColumn(blocks[-1], int_div(F.col(axis), size))
    per_block = per_block.drop(*[f"_last_{axis}" for axis in BLOCK])
    return placed.join(per_block, [*keys, *blocks], how).drop(*blocks)


def attach_image_stats(df: DataFrame, *aggregates: Column, keys: list[str] | None = None) -> DataFrame:
    """Aggregate per image and add the results to every sample."""
    return join_image_stats(df, image_stats(df, *aggregates, keys=keys), keys)


def has_size(df: DataFrame) -> bool:
    return "width" in df.columns and "height" in df.columns


def image_sizes(df: DataFrame) -> DataFrame:
    """Width and height of every image, from its largest coordinates."""
    return image_stats(
        df, (F.max("x") + 1).cast("int").alias("width"), (F.max("y") + 1).cast("int").alias("height")
    )


def with_size(df: DataFrame) -> DataFrame:
    """Make sure samples carry the width and height of their image.

    Scans attach both for free; only tables without them pay the aggregate.
    """
    return df if has_size(df) else join_image_stats(df.drop("width", "height"), image_sizes(df))
