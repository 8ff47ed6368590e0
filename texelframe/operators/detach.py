"""Splitting textures into files along layers, faces and mips: a projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from texelframe.functions.names import part_name

AXES = ("layer", "face", "mip")


def _check_axes(axes) -> tuple[str, ...]:
    """Split axes in fixed order; mips when none is named."""
    unknown = set(axes) - set(AXES)
    if unknown:
        raise ValueError(f"axes must be among {AXES}, got {sorted(unknown)}")
    return tuple(a for a in AXES if a in axes) or ("mip",)


def detach_name(base: Column, axes=("mip",)) -> Column:
    """File a subresource goes to, from its own indices."""
    split = _check_axes(axes)
    return part_name(base, *[F.col(a) if a in split else None for a in AXES])


def detach(sub: DataFrame, axes=("mip",), base: Column | None = None) -> DataFrame:
    """Re-key subresources to the files they are split into.

    Needs texture_id, layer, face, mip and the texture's n_layers, n_faces, n_mips,
    mip0_width, mip0_height. Split axes restart at 0 in each file; ``*_file`` says
    which file of the axis it is, the ``n_*`` counts describe that file, and its
    base size is that of the first mip it holds.
    """
    split = _check_axes(axes)
    base = F.col("texture_id").cast("string") if base is None else base
    changes = {"file": detach_name(base, split)}
    for axis in AXES:
        on = axis in split
        changes[f"{axis}_file"] = F.col(axis) if on else F.lit(0)
        changes[axis] = F.lit(0) if on else F.col(axis)
        count = {"layer": "n_layers", "face": "n_faces", "mip": "n_mips"}[axis]
        changes[count] = F.lit(1) if on else F.col(count)
    first_mip = F.col("mip") if "mip" in split else F.lit(0)
    for size in ("mip0_width", "mip0_height"):
        changes[size] = F.greatest(F.lit(1), F.call_function("shiftright", F.col(size), first_mip))
    return sub.withColumns(changes)


def detach_meta(textures: DataFrame, axes=("mip",)) -> DataFrame:
    """Header fields of the split files: copied, but cube flags drop with split faces."""
    if "face" in _check_axes(axes):
        return textures.withColumn("cube_flags", F.lit(0))
    return textures


def ordered_subresources(sub: DataFrame) -> DataFrame:
    """Storage order inside each texture: layer, then face, then mip."""
    return sub.orderBy("texture_id", *AXES)
