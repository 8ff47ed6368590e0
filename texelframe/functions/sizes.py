"""Mip chain and block arithmetic on image sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from texelframe.schema import ceil_div

UNLIMITED_MIPS = 32


def bit_length(n: Column) -> Column:
    """Bits needed to write n; 0 for n = 0."""
    return F.when(n > 0, F.length(F.bin(n))).otherwise(0)


def mip_size(size: Column, mip: Column | int) -> Column:
    """Size of a level: halved ``mip`` times, never below 1."""
    level = mip if isinstance(mip, Column) else F.lit(mip)
    # a shift by the width of the number or more would start over
    return F.greatest(F.lit(1), F.call_function("shiftright", size, F.least(level, F.lit(31)).cast("int")))


def mip_count(width: Column, height: Column, max_mips: int = UNLIMITED_MIPS, min_size: int = 1) -> Column:
    """Levels of an image, base included, under a level cap and a minimum side.

    A chain ends with its 1x1 level; the base level always exists. Depth plays
    no part.
    """
    limits = [F.lit(int(max_mips)), bit_length(F.greatest(width, height))]
    if min_size > 1:
        # size >> k >= min_size holds exactly while 2^k <= size div min_size
        limits += [bit_length(F.floor(side / min_size)) for side in (width, height)]
    return F.greatest(F.lit(1), F.least(*limits)).cast("int")


def block_count(width: Column, height: Column, block_w: Column | int, block_h: Column | int) -> Column:
    """Blocks covering an image, partial edge blocks included."""
    return ceil_div(width, block_w).cast("bigint") * ceil_div(height, block_h)
