"""Rounding of channel values to storage precisions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from texelframe.functions.color import clamp

# 4x4 ordered-dither (Bayer) matrix, row by row, in sixteenths.
BAYER_4X4 = [
    0, 8, 2, 10,
    12, 4, 14, 6,
    3, 11, 1, 9,
    15, 7, 13, 5,
]


def check_bits(bits: int, low: int = 1, high: int = 32) -> int:
    if not low <= bits <= high:
        raise ValueError(f"bits must be in {low}..{high}, got {bits}")
    return bits


def _steps(bits: int | Column, sign_bits: int = 0, high: int = 32) -> Column | int:
    """Steps between 0 and 1. A column of bits has to hold numbers that are in range."""
    if isinstance(bits, Column):
        return F.pow(F.lit(2.0), bits - sign_bits) - 1
    return 2 ** (check_bits(bits, low=1 + sign_bits, high=high) - sign_bits) - 1


def unorm(c: Column, bits: int | Column) -> Column:
    """Nearest k / (2^bits - 1) in [0, 1]."""
    steps = _steps(bits)
    return F.floor(clamp(c) * steps + 0.5) / steps


def snorm(c: Column, bits: int | Column) -> Column:
    """Nearest k / (2^(bits-1) - 1) in [-1, 1]."""
    steps = _steps(bits, sign_bits=1)
    return F.floor(clamp(c, -1.0, 1.0) * steps + 0.5) / steps


def above_threshold(c: Column, threshold: int | Column) -> Column:
    """1 where the 8-bit value exceeds the threshold, else 0."""
    return F.when(F.floor(clamp(c) * 255 + 0.5) > threshold, 1.0).otherwise(0.0)


def ordered_dither(c: Column, x: Column, y: Column, bits: int | Column) -> Column:
    """Round to ``bits`` bits, 1 to 8, with a position-dependent threshold."""
    steps = _steps(bits, high=8)
    cell = (y % 4) * 4 + x % 4 + 1
    threshold = F.element_at(F.array(*[F.lit(t / 16) for t in BAYER_4X4]), cell.cast("int"))
    return F.floor(clamp(c) * steps + threshold) / steps


# How a format stores channels. Colour and alpha are unsigned fractions of 8 bits, if nothing else is said.
PLAIN, SIGNED, FLOAT, ONE_BIT_ALPHA, RED_ONLY = range(5)
KIND_SHIFT = 16  # a storage code is a kind times this, plus the bits that alpha is dithered to, 0 for no dithering


def stored_colour(c: Column, storage: Column, is_red: bool) -> Column:
    """A colour channel as images of that storage code hold it; null where they don't."""
    kind = F.floor(storage / KIND_SHIFT)
    other = F.lit(None) if not is_red else unorm(c, 8)
    return F.when(kind == FLOAT, c).when(kind == SIGNED, snorm(c, 8)).when(kind == RED_ONLY, other).otherwise(unorm(c, 8))


def stored_alpha(c: Column, x: Column, y: Column, storage: Column) -> Column:
    kind, bits = F.floor(storage / KIND_SHIFT), storage % KIND_SHIFT
    plain = F.when(kind == ONE_BIT_ALPHA, above_threshold(c, 127)).otherwise(unorm(c, 8))
    fraction = F.when(bits > 0, ordered_dither(c, x, y, bits)).otherwise(plain)
    return F.when(kind == FLOAT, c).when(kind == SIGNED, snorm(c, 8)).when(kind == RED_ONLY, F.lit(None)).otherwise(fraction)
