"""Resizing with separable filters, and the next mip level.

Filter weights are computed where they are used, from the sample's position
and its image's size, so no weight table is built, joined or broadcast. Weighted
sums are divided by the sum of their weights at the end, which normalises edge
taps as well.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from texelframe.operators.placement import WRAP_MODES, Span, colocate_tiles, explode_span, virtual_positions, virtual_span
from texelframe.schema import carried, channels, int_div, plane_keys, with_size

# Half-widths in output samples, Mitchell's B and C, and the
# Kaiser window's alpha and stretch.
SUPPORT = {"triangle": 1.0, "mitchell": 2.0, "kaiser": 3.0}
MITCHELL_B = 1 / 3
MITCHELL_C = 1 / 3
KAISER_ALPHA = 4.0
KAISER_STRETCH = 1.0
BESSEL_TERMS = 14
# Reductions from this on are made by sums over the whole image, others tile by tile.
STRONG = 4
# Side of a tile of targets. A task holds the samples of about a hundred tiles as objects before it sorts them.
SIDE = 32

FILTERS = ("box", "min", "max", *SUPPORT)


def _bessel_i0(quarter_square: str) -> str:
    """I0(v) from v*v/4, as a nested power series."""
    total = "1D"
    for k in range(BESSEL_TERMS, 0, -1):
        total = f"({quarter_square} * {total} * {1 / (k * k)!r}D + 1D)"
    return total


def kernel(u: str, square: str, name: str) -> str:
    """SQL expression of the filter weight at distance u, in output samples.

    ``square`` is u * u. Both should be column names: the series repeats the
    square, and a generated method beyond 8000 bytes is left uncompiled by the JVM.
    """
    d = f"abs({u})"
    if name == "triangle":
        return f"greatest(0D, 1D - {d})"
    if name == "mitchell":
        b, c = MITCHELL_B, MITCHELL_C
        near = [(12 - 9 * b - 6 * c) / 6, -(18 - 12 * b - 6 * c) / 6, 0.0, (6 - 2 * b) / 6]
        far = [(-b - 6 * c) / 6, (6 * b + 30 * c) / 6, -(12 * b + 48 * c) / 6, (8 * b + 24 * c) / 6]

        def cubic(k: list[float]) -> str:
            return f"((({k[0]!r}D * {d} + {k[1]!r}D) * {d} + {k[2]!r}D) * {d} + {k[3]!r}D)"

        return f"CASE WHEN {d} < 1 THEN {cubic(near)} WHEN {d} < 2 THEN {cubic(far)} ELSE 0D END"
    if name == "kaiser":
        half = KAISER_ALPHA / 2
        rate = (half / SUPPORT["kaiser"]) ** 2
        peak = sum((half * half) ** k / math.factorial(k) ** 2 for k in range(BESSEL_TERMS + 1))
        window = f"{_bessel_i0(f'({half * half!r}D - {square} * {rate!r}D)')} * {1 / peak!r}D"
        angle = f"({u} * {KAISER_STRETCH * math.pi!r}D)"
        sinc = f"CASE WHEN abs({angle}) < 1e-9D THEN 1D ELSE sin({angle}) / nullif({angle}, 0D) END"
        return f"CASE WHEN {d} < {SUPPORT['kaiser']!r}D THEN ({sinc}) * {window} ELSE 0D END"
    raise ValueError(f"filter must be one of {FILTERS}, got {name!r}")


def _sized_keys(df: DataFrame) -> list[str]:
    """Plane keys plus the sizes, which are constant per image and ride along."""
    counted = [c for c in ("n_mips",) if c in df.columns]
    return plane_keys(df) + ["width", "height", "out_w", "out_h", *counted, *carried(df)]


def _finish(df: DataFrame) -> DataFrame:
    return df.withColumns({"width": F.col("out_w"), "height": F.col("out_h")}).drop("out_w", "out_h")


def _weighted_means(names: list[str]) -> list[Column]:
    return [F.expr(f"sum(_w * {c}) / sum(_w)").alias(c) for c in names]


def _resize_box(df: DataFrame) -> DataFrame:
    """Area average: one aggregate, exact integer overlaps as weights."""
    def targets(index: str, size: str, out: str) -> Column:
        start = f"bigint({index}) * {out}"
        return explode_span((f"int({start} div {size})", f"int(({start} + {out} - 1) div {size})"))

    def overlap(index: str, target: str, size: str, out: str) -> str:
        i, d = f"bigint({index})", f"bigint({target})"
        return f"(least(({i} + 1) * {out}, ({d} + 1) * {size}) - greatest({i} * {out}, {d} * {size}))"

    taps = df.withColumn("_dx", targets("x", "width", "out_w")).withColumn("_dy", targets("y", "height", "out_h"))
    weight = f"double({overlap('x', '_dx', 'width', 'out_w')}) * {overlap('y', '_dy', 'height', 'out_h')}"
    cells = (
        taps.withColumn("_w", F.expr(weight))
        .groupBy(*_sized_keys(df), F.col("_dy").alias("y"), F.col("_dx").alias("x"))
        .agg(*_weighted_means(channels(df)))
    )
    return _finish(cells)


def _reach(size: str, out: str, support: float) -> str:
    """How many positions beyond an edge the filter reads."""
    return f"int(ceil(greatest({size} / {out}, 1D) * {support!r}D))"


def _center(j: str, size: str, out: str) -> str:
    return f"(({j} + 0.5D) * {out} / {size} - 0.5D)"


def _targets(j: str, size: str, out: str, support: float) -> Span:
    """Output samples whose taps include source position j."""
    around = f"{support!r}D / least(1D, {size} / {out})"
    low = f"greatest(0, int(ceil({_center(j, size, out)} - {around})))"
    return low, f"least({out} - 1, int(floor({_center(j, size, out)} + {around})))"


def _taps(rows: DataFrame, j: str, target: str, size: str, out: str, name: str, span: Span) -> DataFrame:
    """A row for each target in span of every source position, with its weight."""
    distance = f"({_center(j, size, out)} - {target}) * least(1D, {size} / {out})"
    return (
        rows.withColumn(target, explode_span(span))
        .withColumn("_u", F.expr(distance))
        .withColumn("_uu", F.expr("_u * _u"))
        .withColumn("_w", F.expr(kernel("_u", "_uu", name)))
    )


def _let(name: str, value: str, body: str) -> str:
    """SQL expression of body with value, evaluated once, under a name."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _reading_tiles(index: str, size: str, out: str, support: float, mode: str) -> Column:
    """One row per tile along an axis that reads the sample, once also where it reads it at several positions."""
    if mode not in WRAP_MODES:
        raise ValueError(f"wrap mode must be one of {WRAP_MODES}, got {mode!r}")
    reach = _reach(size, out, support)
    if mode == "clamp":
        low, _ = _targets(f"if({index} = 0, -{reach}, {index})", size, out, support)
        _, high = _targets(f"if({index} = {size} - 1, {size} - 1 + {reach}, {index})", size, out, support)
        return F.expr(f"explode(sequence(int({low} div {SIDE}), int({high} div {SIDE})))")
    first, last = virtual_span(index, size, reach)
    low, high = _targets("_v", size, out, support)
    touched = f"CASE WHEN {low} <= {high} THEN sequence(int({low} div {SIDE}), int({high} div {SIDE})) ELSE array() END"
    return F.expr(f"explode(array_distinct(flatten(transform(sequence({first}, {last}, {size}), _v -> {touched}))))")


def _tap_lists(tile: str, size: str, out: str, name: str, mode: str) -> str:
    """Array by target of the tile: the source positions it reads (i) with their weights (w)."""
    support = SUPPORT[name]
    middle, reach = f"((_d + 0.5D) * {size} / {out} - 0.5D)", f"greatest({size} / {out}, 1D) * {support!r}D"
    near = f"sequence(int(ceil({middle} - {reach})) - 1, int(floor({middle} + {reach})) + 1)"
    centers = f"transform({near}, _j -> named_struct('j', _j, 'm', {_center('_j', size, out)}))"
    read = f"filter({centers}, _n -> _n.m - _around <= _d AND _n.m + _around >= _d)"
    weight = _let("_u", "(_n.m - _d) * _scale", _let("_uu", "_u * _u", kernel("_u", "_uu", name)))
    at = f"pmod(_n.j, {size})" if mode == "repeat" else f"greatest(0, least({size} - 1, _n.j))"
    taps = f"transform({read}, _n -> named_struct('i', {at}, 'w', {weight}))"
    targets = f"transform(sequence({tile} * {SIDE}, least({out} - 1, {tile} * {SIDE} + {SIDE - 1})), _d -> {taps})"
    return _let("_scale", f"least(1D, {size} / {out})", _let("_around", f"{support!r}D / _scale", targets))


def _placed_taps(taps: str, positions: str) -> str:
    """The same by target: p, with places among the positions that the tile reads (k) for i; s, the sum of weights."""
    placed = f"transform(_t, _p -> named_struct('k', int(array_position({positions}, _p.i)) - 1, 'w', _p.w))"
    return f"transform({taps}, _t -> named_struct('p', {placed}, 's', aggregate(_t, 0D, (_s, _p) -> _s + _p.w)))"


def _struct(names: list[str], value: Callable[[str], str]) -> str:
    return "named_struct(" + ", ".join(f"'{c}', {value(c)}" for c in names) + ")"


def _full_means(names: list[str]) -> str:
    """Means of a tile with one sample, without nulls, for each place it reads: ``_cells`` are lines of equal length."""
    values = "transform(slice(_cells, _k * size(_xs) + 1, size(_xs)), _e -> _e.{c})"
    over = "transform(_across, _t -> aggregate(_t.p, 0D, (_s, _p) -> _s + _p.w * get(_values, _p.k)) / _t.s)"
    lines = f"transform(sequence(0, size(_ys) - 1), _k -> {_struct(names, lambda c: _let('_values', values.format(c=c), over))})"
    read = f"transform(_t.p, _p -> named_struct('w', _p.w, {', '.join(f"'{c}', get(_lines, _p.k).{c}" for c in names)}))"
    mean = _struct(names, lambda c: f"aggregate(_read, 0D, (_s, _l) -> _s + _l.w * get(_l.{c}, _c)) / _t.s")
    down = f"transform(_down, _t -> {_let('_read', read, f'transform(sequence(0, size(_across) - 1), _c -> {mean})')})"
    return _let("_lines", lines, f"flatten({down})")


def _sparse_means(names: list[str]) -> str:
    """Means of any tile. Each sample of a place has the weight; a null has weight but no value; null where nothing is read."""
    def means(value: str, present: str, count: str) -> str:
        """Weighted means over the taps of _t, where value.c and count are those at the tap _p."""
        weights = f"aggregate(_t.p, 0D, (_s, _p) -> _s + _p.w * {count})"
        total = "aggregate(_t.p, CAST(NULL AS DOUBLE), (_s, _p) -> coalesce(_s + _p.w * {v}, _s, _p.w * {v}))"
        each = _struct(names, lambda c: total.format(v=f"{value}.{c}") + " / _ws")
        return f"IF(exists(_t.p, _p -> {present}), {_let('_ws', weights, each)}, NULL)"

    total = "aggregate(_f, CAST(NULL AS DOUBLE), (_s, _e) -> coalesce(_s + _e.{c}, _s, _e.{c}))"
    sums = ", ".join(f"'{c}', {total.format(c=c)}" for c in names)
    merged = _let("_f", "filter(_line, _e -> _e.x = _x)", f"named_struct('n', double(size(_f)), {sums})")
    line = _let("_line", "filter(_cells, _e -> _e.y = _y)", f"transform(_xs, _x -> {merged})")
    cell, mean = "get(_values, _p.k)", "get(get(_lines, _p.k), _c)"
    lines = f"transform(_grid, _values -> transform(_across, _t -> {means(cell, f'{cell}.n > 0', f'{cell}.n')}))"
    count = f"IF({mean} IS NULL, 0D, 1D)"
    down = f"transform(_down, _t -> transform(sequence(0, size(_across) - 1), _c -> {means(mean, f'{mean} IS NOT NULL', count)}))"
    return _let("_grid", f"transform(_ys, _y -> {line})", _let("_lines", lines, f"flatten({down})"))


def _tile_means(names: list[str], name: str, mode: str) -> str:
    """Array of the means at a tile's targets, line by line, from its samples ``_cells`` in order: x first, then y."""
    def positions(taps: str) -> str:
        return f"array_sort(array_distinct(flatten(transform({taps}, _t -> _t.i))))"

    places = "flatten(transform(_ys, _y -> transform(_xs, _x -> shiftleft(bigint(_y), 32) + _x)))"
    full = f"transform(_cells, _e -> shiftleft(bigint(_e.y), 32) + _e.x) = {places}"
    known = f"forall(_cells, _e -> {' AND '.join(f'_e.{c} IS NOT NULL' for c in names)})"
    result = f"IF({full} AND {known}, {_full_means(names)}, {_sparse_means(names)})"
    for local, value in (
        ("_down", _placed_taps("_tapy", "_ys")),
        ("_across", _placed_taps("_tapx", "_xs")),
        ("_ys", positions("_tapy")),
        ("_xs", positions("_tapx")),
        ("_tapy", _tap_lists("ty", "height", "out_h", name, mode)),
        ("_tapx", _tap_lists("tx", "width", "out_w", name, mode)),
    ):
        result = _let(local, value, result)
    return result


def _resize_by_tile(df: DataFrame, name: str, mode: str) -> DataFrame:
    """Each sample once to every tile that reads it; a tile is a row, both passes are made inside it.

    Until its tiles are whole a task keeps samples, which are fewer than the sums of a pass and sorted
    beyond a few tiles, and writes their targets as it makes them.
    """
    support, names = SUPPORT[name], channels(df)
    keys = _sized_keys(df)
    rows = df.select(*keys, "y", "x", *names)
    rows = rows.withColumn("ty", _reading_tiles("y", "height", "out_h", support, mode))
    rows = rows.withColumn("tx", _reading_tiles("x", "width", "out_w", support, mode))
    cells = F.expr(f"sort_array(collect_list(struct(y, x, {', '.join(names)})))")
    tiles = colocate_tiles(rows).groupBy(*keys, "tile", "ty", "tx").agg(cells.alias("_cells"))
    means = tiles.select(*keys, "ty", "tx", F.expr(f"posexplode({_tile_means(names, name, mode)})").alias("_at", "_mean"))
    across = f"least({SIDE}, out_w - tx * {SIDE})"
    cells = means.filter("_mean IS NOT NULL").select(
        *keys, F.expr(f"ty * {SIDE} + int(_at div {across})").alias("y"), F.expr(f"tx * {SIDE} + _at % {across}").alias("x"), "_mean.*"
    )
    return _finish(cells)


def _resize_by_sums(df: DataFrame, name: str, mode: str, axes: str) -> DataFrame:
    """Two aggregates, one per axis, whose sums are combined before they are exchanged.

    For strong reductions: most samples of a task go into the same few sums, so that the exchange carries
    the reduced image, and its keys are the samples of the result, many for one image however
    small that is made. Samples at an edge also stand for the positions beyond it, at most twice the filter's half-width
    over the result's side as many again.
    """
    support = SUPPORT[name]
    size = {"x": ("width", "out_w"), "y": ("height", "out_h")}
    rows = df
    for axis, other in (axes, axes[::-1]):
        rows = rows.withColumn("_j", virtual_positions(axis, size[axis][0], _reach(*size[axis], support), mode))
        hit = _taps(rows, "_j", "_d", *size[axis], name, _targets("_j", *size[axis], support))
        rows = hit.groupBy(*_sized_keys(df), other, F.col("_d").alias(axis)).agg(*_weighted_means(channels(df)))
    return _finish(rows)


def _resize_kernel(df: DataFrame, name: str, mode: str) -> DataFrame:
    """Each image by the way that suits its reduction; its stronger axis first where sums are combined."""
    across, down = F.col("width") / F.col("out_w"), F.col("height") / F.col("out_h")
    strong = F.greatest(across, down) >= STRONG
    ways = [
        _resize_by_tile(df.filter(~strong), name, mode),
        _resize_by_sums(df.filter(strong & (across >= down)), name, mode, "xy"),
        _resize_by_sums(df.filter(strong & (across < down)), name, mode, "yx"),
    ]
    return ways[0].unionByName(ways[1]).unionByName(ways[2])


def _halve_extreme(df: DataFrame, name: str) -> DataFrame:
    """Minimum or maximum of each 2x2 cell; a last odd row or column joins the cell before."""
    extreme = F.min if name == "min" else F.max
    y = F.least(int_div(F.col("y"), 2), F.col("out_h") - 1).alias("y")
    x = F.least(int_div(F.col("x"), 2), F.col("out_w") - 1).alias("x")
    cells = df.groupBy(*_sized_keys(df), y, x).agg(*[extreme(c).alias(c) for c in channels(df)])
    return _finish(cells)


def resize(df: DataFrame, width: Column | int, height: Column | int, name: str = "box", wrap: str = "clamp") -> DataFrame:
    """Resample every image to the given size."""
    def as_int(v: Column | int) -> Column:
        return (v if isinstance(v, Column) else F.lit(v)).cast("int")

    sized = with_size(df).withColumns({"out_w": as_int(width), "out_h": as_int(height)})
    if name == "box":
        return _resize_box(sized)
    if name not in SUPPORT:
        raise ValueError(f"resize filter must be box or one of {tuple(SUPPORT)}, got {name!r}")
    return _resize_kernel(sized, name, wrap)


def next_mip(df: DataFrame, name: str = "box", wrap: str = "clamp") -> DataFrame:
    """The next smaller level of every image; a mip column is counted up."""
    sized = with_size(df).withColumns(
        {"out_w": F.greatest(F.lit(1), int_div(F.col("width"), 2)), "out_h": F.greatest(F.lit(1), int_div(F.col("height"), 2))}
    )
    if name in ("min", "max"):
        level = _halve_extreme(sized, name)
    elif name == "box":
        level = _resize_box(sized)
    elif name in SUPPORT:
        level = _resize_by_tile(sized, name, wrap)
    else:
        raise ValueError(f"filter must be one of {FILTERS}, got {name!r}")
    return level.withColumn("mip", F.col("mip") + 1) if "mip" in df.columns else level
