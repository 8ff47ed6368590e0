"""The format dimension and what follows from it: block sizes and byte counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from texelframe.functions import quantize
from texelframe.functions.sizes import UNLIMITED_MIPS, block_count, mip_count, mip_size

# Formats with 4x4 blocks and their bytes per block.
BLOCK_BYTES = {
    "bc1": 8, "bc1n": 8, "bc1a": 8, "bc2": 16, "bc3": 16, "bc3n": 16, "bc3_rgbm": 16,
    "bc4": 8, "bc4s": 8, "ati2": 16, "bc5": 16, "bc5s": 16, "bc6": 16, "bc6s": 16, "bc7": 16,
}
# Unblocked formats and their bytes per pixel.
PIXEL_BYTES = {"rgb": 4, "lumi": 1}
# ASTC block sizes; every block takes 16 bytes.
ASTC_BLOCKS = (
    (4, 4), (5, 4), (5, 5), (6, 5), (6, 6), (8, 5), (8, 6), (8, 8),
    (10, 5), (10, 6), (10, 8), (10, 10), (12, 10), (12, 12),
)
ASTC_BLOCK_BYTES = 16
# Formats whose pixels are not plain unsigned fractions.
PIXEL_TYPES = {"bc4s": "signed_norm", "bc5s": "signed_norm", "bc6": "unsigned_float", "bc6s": "float"}

COLUMNS = "format, family, block_w, block_h, block_bytes, pixel_type, dds10"


def format_rows() -> list[tuple]:
    rows = [(f, "raw", 1, 1, size) for f, size in PIXEL_BYTES.items()]
    rows += [(f, "bc", 4, 4, size) for f, size in BLOCK_BYTES.items()]
    rows += [(f"astc_ldr_{w}x{h}", "astc", w, h, ASTC_BLOCK_BYTES) for w, h in ASTC_BLOCKS]
    extended = ("bc6", "bc6s", "bc7")
    return [
        (*row, PIXEL_TYPES.get(row[0], "unsigned_norm"), row[1] == "astc" or row[0] in extended) for row in rows
    ]


def format_dim(spark: SparkSession) -> DataFrame:
    """One row per format: block size, bytes, pixel type, need of the extended header."""
    rows = ", ".join(f"({', '.join(repr(v) for v in row)})" for row in format_rows())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS formats({COLUMNS})")


def with_format(textures: DataFrame) -> DataFrame:
    """Attach the format's properties; the dimension is a fixed short list.

    Textures of a format that isn't in it stay, with nulls (see unknown_formats).
    """
    return textures.join(F.broadcast(format_dim(textures.sparkSession)), "format", "left")


def storage(
    format: Column, alpha_dithering: Column, alpha: Column, alpha_bits: Column, luminance: Column
) -> Column:
    """Code of what a format stores (see functions.quantize), null for an unknown one.

    Dithered alpha has 1 bit in bc1a and 4 in bc2. Other plain formats dither it, to 8 bits, only where
    transparency is asked for (``alpha`` true). ``alpha_bits``, where it isn't null, is the
    number of bits instead, but for bc1a.
    """
    kinds: dict[int, list[str]] = {}
    for name, *_, pixel_type, _ in format_rows():
        kind = quantize.PLAIN
        if pixel_type == "signed_norm":
            kind = quantize.SIGNED
        elif pixel_type.endswith("float"):
            kind = quantize.FLOAT
        elif name in ("bc1a", "lumi"):
            kind = {"bc1a": quantize.ONE_BIT_ALPHA, "lumi": quantize.RED_ONLY}[name]
        kinds.setdefault(kind, []).append(name)
    code = F.when(luminance & format.isNotNull(), quantize.RED_ONLY)
    for kind, names in kinds.items():
        code = code.when(format.isin(names), kind)
    wanted = F.coalesce(alpha_dithering, F.lit(False))
    plain = format.isin(kinds[quantize.PLAIN]) & F.coalesce(alpha, F.lit(False))
    bits = (
        F.when(~wanted | luminance, 0)
        .when(format == "bc1a", 1)
        .when(format == "bc2", F.coalesce(alpha_bits, F.lit(4)))
        .when(plain, F.coalesce(alpha_bits, F.lit(8)))
        .otherwise(0)
    )
    return (code * quantize.KIND_SHIFT + bits).cast("int")


def unknown_formats(textures: DataFrame) -> DataFrame:
    """Textures whose format is null or none that is known."""
    return textures.join(F.broadcast(format_dim(textures.sparkSession).select("format")), "format", "left_anti").select(*textures.columns)


def mip_plan(textures: DataFrame, max_mips: int = UNLIMITED_MIPS, min_size: int = 1) -> DataFrame:
    """One row per level of each texture, with the level's size."""
    count = mip_count(F.col("width"), F.col("height"), max_mips, min_size)
    levels = textures.withColumn("mip", F.explode(F.sequence(F.lit(0), count - 1)))
    return levels.withColumns(
        {"mip_width": mip_size(F.col("width"), F.col("mip")), "mip_height": mip_size(F.col("height"), F.col("mip"))}
    )


def size_estimate(textures: DataFrame, max_mips: int = UNLIMITED_MIPS, min_size: int = 1) -> DataFrame:
    """Compressed bytes of each texture over all its levels, layers and faces; null for an unknown format.

    Without n_layers or n_faces there is one of them.
    """
    levels = mip_plan(with_format(textures), max_mips, min_size)
    blocks = block_count(F.col("mip_width"), F.col("mip_height"), F.col("block_w"), F.col("block_h"))
    bytes_of_level = blocks * F.col("depth") * F.col("block_bytes")
    for count in ("n_layers", "n_faces"):
        if count in textures.columns:
            bytes_of_level = bytes_of_level * F.col(count)
    return levels.groupBy("texture_id", "format").agg(
        F.sum(bytes_of_level).cast("bigint").alias("total_bytes"), F.count(F.lit(1)).alias("n_mips")
    )
