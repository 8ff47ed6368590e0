"""Virtual neighbours beyond the image edge, and placement by tile.

Neighbourhood work runs tile by tile: each sample is sent once to every tile that
reads it (its own, plus the neighbours' margins), and all further grouping by
(plane, tile, ...) stays inside the partition. The exchange carries little more
than the input itself, whatever the number of taps, and no tile is larger than
its fixed side plus margin.

Positions and spans are given as SQL expressions over the row's columns: they are
long, and a text is handed to Spark in one call where a Column tree takes hundreds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from texelframe.schema import plane_keys

TILE = 64
WRAP_MODES = ("clamp", "repeat")

Span = tuple[str, str]


def explode_span(span: Span, step: str = "1") -> Column:
    """One row per integer in low..high; no row when the span is empty."""
    low, high = span
    return F.expr(f"explode(CASE WHEN {low} <= {high} THEN sequence({low}, {high}, {step}) END)")


def wrap(position: Column, size: Column, mode: str = "clamp") -> Column:
    """Source index a position outside the image reads from."""
    if mode == "clamp":
        return F.least(size - 1, F.greatest(F.lit(0), position))
    if mode == "repeat":
        return F.pmod(position, size)
    raise ValueError(f"wrap mode must be one of {WRAP_MODES}, got {mode!r}")


def virtual_span(index: str, size: str, reach: str) -> Span:
    """First and last position of a repeated sample in -reach .. size-1+reach; its others lie between, a size apart."""
    low = f"({index} - {size} * int(({index} + {reach}) div {size}))"
    high = f"({index} + {size} * int(({size} - 1 + {reach} - {index}) div {size}))"
    return low, high


def virtual_positions(index: str, size: str, reach: str, mode: str = "clamp") -> Column:
    """Rows for every position in -reach .. size-1+reach that reads this index.

    Clamp: edge samples also stand for everything beyond them. Repeat: a sample
    stands for its copies one image size apart.
    """
    if mode == "clamp":
        low = f"if({index} = 0, -({reach}), {index})"
        high = f"if({index} = {size} - 1, {size} - 1 + {reach}, {index})"
        return explode_span((low, high))
    if mode == "repeat":
        return explode_span(virtual_span(index, size, reach), size)
    raise ValueError(f"wrap mode must be one of {WRAP_MODES}, got {mode!r}")


def colocate_tiles(df: DataFrame) -> DataFrame:
    """Bring the rows of each (plane, ty, tx) together, under the single key ``tile``.

    Grouping by ``tile`` and anything else then needs no further exchange. The key
    is a hash, so the real keys still belong in the grouping; it is used because a
    plain key that happens to be constant would not be recognised.
    """
    return df.withColumn("tile", F.xxhash64(*plane_keys(df), "ty", "tx")).repartition("tile")


def place_by_tile(df: DataFrame, y_span: Span, x_span: Span) -> DataFrame:
    """Send each row to every tile its target span touches.

    Adds ty, tx and tile; rows with an empty span reach no target and drop out.
    """
    def tiles(span: Span) -> Column:
        low, high = span
        touched = f"sequence(int(({low}) div {TILE}), int(({high}) div {TILE}))"
        return F.expr(f"explode(CASE WHEN {low} <= {high} THEN {touched} END)")

    return colocate_tiles(df.withColumn("ty", tiles(y_span)).withColumn("tx", tiles(x_span)))
