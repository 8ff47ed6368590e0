"""File-name rules: output names, part names and name-driven switches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAME_TAGS = ("rgbm", "bc3n", "bc6")
CONTAINER_MAGIC = b"DDS "


def replace_extension(path: Column, extension: str) -> Column:
    """Swap the last extension of the file name; add one if there is none."""
    stem = F.regexp_replace(path, r"(?<=[^/])\.[^./]*$", "")
    return F.concat(stem, F.lit(extension))


def name_tags(path: Column, basename_only: bool = False) -> dict[str, Column]:
    """One flag per tag found in the path. Tags are independent and may stack."""
    text = F.regexp_extract(path, r"[^/]*$", 0) if basename_only else path
    return {tag: F.contains(text, F.lit(tag)) for tag in NAME_TAGS}


def is_container(content: Column) -> Column:
    """True for bytes that start with the container magic."""
    return F.substring(content, 1, 4) == F.lit(CONTAINER_MAGIC)


def plane_name(base: Column, face: Column | None, mip: Column | None, extension: str) -> Column:
    parts = [base]
    if face is not None:
        parts += [F.lit("_face"), face.cast("string")]
    if mip is not None:
        parts += [F.lit("_mipmap"), mip.cast("string")]
    return F.concat(*parts, F.lit(extension))


def part_name(base: Column, layer: Column | None, face: Column | None, mip: Column | None) -> Column:
    """Name of a split-off file: only split axes appear, in layer, face, mip order."""
    parts = [base]
    for letter, index in (("L", layer), ("F", face), ("M", mip)):
        if index is not None:
            parts += [F.lit(f"_{letter}"), index.cast("string")]
    return F.concat(*parts, F.lit(".dds"))
