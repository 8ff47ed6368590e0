"""Colour-space curves and per-channel arithmetic as Column functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the sRGB transfer curve (IEC 61966-2-1).
SRGB_ENCODED_KNEE = 0.04045
SRGB_LINEAR_KNEE = 0.0031308
SRGB_SLOPE = 12.92
SRGB_OFFSET = 0.055
SRGB_EXPONENT = 2.4
# Fixed value: least multiplier of RGBM.
RGBM_THRESHOLD = 0.15

Number = Column | float


def clamp(c: Column, low: Number = 0.0, high: Number = 1.0) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), c))


def scale_bias(c: Column, scale: Column | float, bias: Column | float = 0.0) -> Column:
    return c * scale + bias


def gamma_encode(c: Column, gamma: Number) -> Column:
    return F.pow(F.greatest(F.lit(0.0), c), F.lit(1.0 / gamma))


def gamma_decode(c: Column, gamma: Number) -> Column:
    return F.pow(F.greatest(F.lit(0.0), c), gamma if isinstance(gamma, Column) else F.lit(float(gamma)))


def _srgb_decode_positive(u: Column) -> Column:
    return F.when(u <= SRGB_ENCODED_KNEE, u / SRGB_SLOPE).otherwise(
        F.pow((u + SRGB_OFFSET) / (1 + SRGB_OFFSET), F.lit(SRGB_EXPONENT))
    )


def _srgb_encode_positive(u: Column) -> Column:
    return F.when(u <= SRGB_LINEAR_KNEE, u * SRGB_SLOPE).otherwise(
        F.pow(u, F.lit(1 / SRGB_EXPONENT)) * (1 + SRGB_OFFSET) - SRGB_OFFSET
    )


def srgb_decode(c: Column) -> Column:
    """sRGB to linear, clamped to [0, 1]."""
    return _srgb_decode_positive(clamp(c))


def srgb_encode(c: Column) -> Column:
    """Linear to sRGB, clamped to [0, 1]."""
    return _srgb_encode_positive(clamp(c))


def srgb_decode_unclamped(c: Column) -> Column:
    """sRGB to linear; values beyond 1 follow the curve, negatives mirror it."""
    return F.signum(c) * _srgb_decode_positive(F.abs(c))


def srgb_encode_unclamped(c: Column) -> Column:
    return F.signum(c) * _srgb_encode_positive(F.abs(c))


def largest(cols: list[Column]) -> Column:
    return F.greatest(*cols)


def weighted_mean(cols: list[Column], weights: list[Number]) -> Column:
    total = reduce(lambda s, w: s + w, weights)
    if not isinstance(total, Column) and total == 0:
        raise ValueError("channel weights must not sum to zero")
    return reduce(lambda s, cw: s + cw[0] * cw[1], zip(cols, weights), F.lit(0.0)) / total


def reinhard(c: Column, exposure: float) -> Column:
    """Tone curve e*c / (1 + e*c) on the non-negative part of c."""
    lit = F.greatest(F.lit(0.0), c) * exposure
    return lit / (lit + 1)


def tone_map(c: Column, r: Column, g: Column, b: Column) -> Column:
    """A channel brought into range by the factor of the largest one."""
    peak = largest([r, g, b])
    return F.when(peak > 1, c / peak).otherwise(c)


def rgbm_multiplier(r: Column, g: Column, b: Column, threshold: Number = RGBM_THRESHOLD, value_range: float = 1.0) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(threshold), largest([r, g, b]) / value_range))


def rgbm_encode(c: Column, r: Column, g: Column, b: Column, threshold: Number = RGBM_THRESHOLD, value_range: float = 1.0) -> Column:
    return clamp(c / (rgbm_multiplier(r, g, b, threshold, value_range) * value_range))


def rgbm_alpha(r: Column, g: Column, b: Column, threshold: Number = RGBM_THRESHOLD, value_range: float = 1.0) -> Column:
    return (rgbm_multiplier(r, g, b, threshold, value_range) - threshold) / (F.lit(1.0) - threshold)


def rgbm_decode(c: Column, a: Column, threshold: Number = RGBM_THRESHOLD, value_range: float = 1.0) -> Column:
    return c * (a * (F.lit(1.0) - threshold) + threshold) * value_range


def premultiply(c: Column, a: Column) -> Column:
    return c * a


def demultiply(c: Column, a: Column, epsilon: Number = 1e-12) -> Column:
    return c / F.greatest(a, F.lit(epsilon))


def normalized(c: Column, r: Column, g: Column, b: Column, up: Number) -> Column:
    """A component of the packed normal (r, g, b) at unit length; ``up`` where that is a zero vector."""
    unpacked = [v * 2 - 1 for v in (r, g, b)]
    length = F.sqrt(reduce(lambda s, v: s + v, [v * v for v in unpacked]))
    return F.when(length > 0, (c * 2 - 1) / F.nullif(length, F.lit(0.0)) * 0.5 + 0.5).otherwise(F.lit(up))


def slope(c: Column, z: Column) -> Column:
    """Slope of a packed normal's component, centred at 0.5; c itself where blue is 0."""
    # nullif keeps the untaken branch from dividing by zero
    return F.when(z == 0, c).otherwise((c * 2 - 1) / F.nullif(z, F.lit(0.0)) * 0.5 + 0.5)


def grey(r: Column, g: Column, b: Column, a: Column, wr: Number, wg: Number, wb: Number, wa: Number) -> Column:
    return weighted_mean([r, g, b, a], [wr, wg, wb, wa])
