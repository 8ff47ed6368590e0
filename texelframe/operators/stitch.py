"""Joining files back into textures, with every fault reported as a row.

A part is one subresource inside one file: ``base`` and ``file``, the file's place
on each axis (layer_file, face_file, mip_file), the file's header (n_layers,
n_faces, n_mips, width, height, depth, format, alpha_mode, color_transform) and
the subresource's indices inside the file (layer, face, mip).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from texelframe.functions.sizes import mip_size
from texelframe.session import cut_lineage

FILE_KEYS = ("layer_file", "face_file", "mip_file")
HEADER = ("n_layers", "n_faces", "n_mips", "width", "height", "depth", "format", "alpha_mode", "color_transform")
MAX_INDEX = 2**32 - 1
MAX_FACES = 6
# Layers per join key: a texture with very many layers spreads over many keys.
LAYER_BAND = 64
# Places that a word of a bitmap tells of, as the lower bits of a long.
WORD = 32
# Places of a file grid that are looked at together when some of them are missing.
GRID_BLOCK = WORD * WORD


def parse_parts(files: DataFrame, layers: bool = True, faces: bool = True, mips: bool = True) -> DataFrame:
    """Read base name and file indices from names like ``wall_L0_F2_M1.dds``.

    The mip may be named ``_M1`` or ``_1``; ``priority`` 1 marks the preferred
    form. Files that do not follow the naming drop out, and so do those with an index
    beyond 32 bits (see part_name_errors).
    """
    axes = _axes(layers, faces, mips)
    parsed = _parsed(files, layers, faces, mips)
    return parsed.filter(axes["layer_file"].isNotNull() & axes["face_file"].isNotNull() & axes["mip_file"].isNotNull()).withColumns(
        {
            "base": F.col("_groups")[0],
            **axes,
            "priority": F.when(F.col("_groups")[3] == "M", 1).otherwise(2) if mips else F.lit(1),
        }
    ).drop("_groups")


def part_name_errors(files: DataFrame, layers: bool = True, faces: bool = True, mips: bool = True) -> DataFrame:
    """Files named like parts, with an index that is too large, one row each."""
    parsed = _parsed(files, layers, faces, mips)
    wrong = [F.when(index.isNull(), F.lit(axis)) for axis, index in _axes(layers, faces, mips).items()]
    return parsed.withColumn("axis", F.coalesce(*wrong)).filter(F.col("axis").isNotNull()).select("file", "axis", F.lit("index").alias("code"))


def _axes(layers: bool, faces: bool, mips: bool) -> dict[str, Column]:
    """Index of each axis that is named, 0 of one that isn't, null of one beyond 32 bits."""

    def index(named: bool, i: int) -> Column:
        if not named:
            return F.lit(0).cast("bigint")
        value = F.col("_groups")[i].try_cast("bigint")
        return F.when(value <= MAX_INDEX, value)

    return {"layer_file": index(layers, 1), "face_file": index(faces, 2), "mip_file": index(mips, 4)}


def _parsed(files: DataFrame, layers: bool, faces: bool, mips: bool) -> DataFrame:
    pattern = "^(.*)"
    pattern += r"_L(0|[1-9]\d*)" if layers else "()"
    pattern += r"_F(0|[1-9]\d*)" if faces else "()"
    pattern += r"_(M?)(0|[1-9]\d*)" if mips else "()()"
    pattern += r"\.dds$"
    # one match per name: its groups, joined by a character no name holds. It stands behind a generator,
    # for the optimizer would put a match into every expression that uses one of the groups
    groups = F.split(F.regexp_replace("file", pattern, "$1\0$2\0$3\0$4\0$5"), "\0")
    return files.withColumn("_groups", F.explode(F.array(groups))).filter(F.size("_groups") == 5)


def resolve_part_names(parsed: DataFrame) -> DataFrame:
    """One file per place: the ``_M`` form wins over the plain one."""
    keys = ["base", *FILE_KEYS]
    rest = [c for c in parsed.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct("priority", "file")).alias("_best")
    return parsed.groupBy(*keys).agg(best).select(*keys, "_best.*")


def _is_first() -> Column:
    at_zero = F.lit(True)
    for axis in FILE_KEYS:
        at_zero = at_zero & (F.col(axis) == 0)
    return at_zero


def _bit(index: str) -> str:
    """SQL expression of the bit that an index has in its word."""
    return f"shiftleft(1L, int({index} % {WORD}))"


def _first_zero(bits: str) -> str:
    """SQL expression of the place of the lowest zero in a word, WORD if it has none."""
    return f"bit_count((({bits} + 1) & ~{bits}) - 1)"


def _axis_words(places: DataFrame) -> DataFrame:
    """Bitmaps of (base, axis, i) in two steps: per WORD indices, then per WORD words.

    ``_end`` is the lowest index within the step's span that is absent, null if none is.
    """
    words = places.groupBy("base", "axis", F.expr(f"i div {WORD}").alias("_word")).agg(F.expr(f"bit_or({_bit('i')})").alias("_bits"))
    ends = f"CASE WHEN {_first_zero('_bits')} < {WORD} THEN _word * {WORD} + {_first_zero('_bits')} END"
    blocks = words.withColumn("_end", F.expr(ends)).groupBy("base", "axis", F.expr(f"_word div {WORD}").alias("_block")).agg(
        F.expr(f"bit_or({_bit('_word')})").alias("_bits"), F.min("_end").alias("_end")
    )
    absent = f"CASE WHEN {_first_zero('_bits')} < {WORD} THEN (_block * {WORD} + {_first_zero('_bits')}) * {WORD} END"
    return blocks.select("base", "axis", "_block", F.expr(f"least(_end, {absent})").alias("_end"))


def stitch_extent(parts: DataFrame) -> DataFrame:
    """Files per axis: counted along the axis, others at 0, up to the first gap.

    Places become bits: the first zero ends an axis, in no order and without a join. A base's
    blocks of WORD * WORD indices, at most a few million, meet in one row at last. Bases without a
    first file are absent (see stitch_empty).
    """
    def on_axis(axis: str) -> Column:
        others_at_zero = [F.col(o) == 0 for o in FILE_KEYS if o != axis]
        entry = F.struct(F.lit(axis).alias("axis"), F.col(axis).cast("bigint").alias("i"))
        return F.when(others_at_zero[0] & others_at_zero[1], entry)

    places = parts.select("base", F.explode(F.array_compact(F.array(*map(on_axis, FILE_KEYS)))).alias("_e")).select("base", "_e.axis", "_e.i")
    span = WORD * WORD

    def length(axis: str) -> Column:
        of = f"FILTER (WHERE axis = '{axis}')"
        after = f"max(_block) {of} + 1"
        # blocks are a gapless run from 0 on nearly always; else the first absent one is looked for
        gap = f"array_min(array_except(sequence(0L, {after}), collect_set(_block) {of}))"
        return F.expr(f"least(min(_end) {of}, {span} * (CASE WHEN count(*) {of} = {after} THEN {after} ELSE {gap} END))").alias(axis + "s")

    # every axis of a base with a first file has index 0
    return _axis_words(places).groupBy("base").agg(*map(length, FILE_KEYS)).filter(" AND ".join(f"{axis}s > 0" for axis in FILE_KEYS))


def _first_files(parts: DataFrame) -> DataFrame:
    """One row per base: header of its first file, as ``first_*``, and extents."""
    firsts = (
        parts.filter(_is_first())
        .groupBy("base")
        .agg(*[F.any_value(h).alias(f"first_{h}") for h in HEADER])
    )
    return firsts.join(stitch_extent(parts), "base")


def _with_first(parts: DataFrame, firsts: DataFrame | None = None) -> DataFrame:
    """Parts inside the extents of their base, with the first file's header.

    Joined by base and layer band, as one base may hold a large share of all parts.
    """
    firsts = _first_files(parts) if firsts is None else firsts
    last_band = F.floor((F.col("layer_files") - 1) / LAYER_BAND)
    firsts = firsts.withColumn("_band", F.explode(F.sequence(F.lit(0).cast("bigint"), last_band)))
    joined = parts.withColumn("_band", F.floor(F.col("layer_file") / LAYER_BAND)).join(firsts, ["base", "_band"])
    for axis in FILE_KEYS:
        joined = joined.filter(F.col(axis) < F.col(axis + "s"))
    return joined.drop("_band")


def stitch_empty(bases: DataFrame, parts: DataFrame) -> DataFrame:
    """Requested bases without a first file."""
    first = parts.filter(_is_first()).select("base")
    return bases.select("base").distinct().join(first, "base", "left_anti")


EXTENTS = ("layer_files", "face_files", "mip_files")
GRID_SIZE = "layer_files * face_files * mip_files"
GRID_CELL = "(layer_file * face_files + face_file) * mip_files + mip_file"


def _grid_words(placed: DataFrame, *aggregates: Column) -> DataFrame:
    """Bitmaps of the places of each base's file grid that some file fills, in words, with other aggregates of their files."""
    cell = placed.withColumn("_cell", F.expr(GRID_CELL))
    return cell.groupBy("base", *EXTENTS, F.expr(f"_cell div {WORD}").alias("_word")).agg(
        F.expr(f"bit_or({_bit('_cell')})").alias("_bits"), *aggregates
    )


def stitch_missing(parts: DataFrame, firsts: DataFrame | None = None) -> DataFrame:
    """Places of the layer x face x mip file grid that no file fills.

    Files become bits, and the words of GRID_BLOCK places meet with the block they should fill, of which
    only the extents know. Blocks that are full are settled by counting bits; the zeros of others are
    the result. No grid is laid out beside that, nothing is joined to it.
    """
    firsts = _first_files(parts) if firsts is None else firsts
    words = _grid_words(_with_first(parts, firsts))
    held = words.select(
        "base", *EXTENTS, F.expr(f"_word div {WORD}").alias("_block"),
        F.expr(f"struct(_word % {WORD} AS slot, _bits AS bits)").alias("_held"), F.expr("bit_count(_bits)").alias("_n"),
    )
    whole = firsts.select(
        "base", *EXTENTS, F.expr(f"explode(sequence(0L, ({GRID_SIZE} - 1) div {GRID_BLOCK}))").alias("_block"),
        F.lit(None).cast(held.schema["_held"].dataType).alias("_held"), F.lit(0).alias("_n"),
    )
    blocks = held.unionByName(whole).groupBy("base", *EXTENTS, "_block").agg(F.collect_list("_held").alias("_held"), F.sum("_n").alias("_n"))
    last = f"least({GRID_SIZE}, (_block + 1) * {GRID_BLOCK}) - 1"
    short = blocks.filter(F.expr(f"_n < {last} - _block * {GRID_BLOCK} + 1")).withColumn("_words", F.map_from_entries("_held"))
    bits = f"coalesce(element_at(_words, c div {WORD} % {WORD}), 0L)"
    zeros = f"filter(sequence(_block * {GRID_BLOCK}, {last}), c -> {bits} & shiftleft(1L, int(c % {WORD})) = 0)"
    cells = short.select("base", *EXTENTS, F.expr(f"explode({zeros})").alias("_cell"))
    return cells.select(
        "base",
        F.expr("_cell div (face_files * mip_files)").alias("layer_file"),
        F.expr("_cell div mip_files % face_files").alias("face_file"),
        F.expr("_cell % mip_files").alias("mip_file"),
    )


def _checks() -> dict[str, tuple[Column, Column]]:
    """What a file has to share with the first one of its base: for each fault, whether it is there, and the file's own value."""
    first_mip = F.col("first_n_mips").cast("bigint") * F.col("mip_file")

    def differs(*pairs) -> Column:
        wrong = F.lit(False)
        for actual, expected in pairs:
            wrong = wrong | ~F.equal_null(actual, expected)
        return wrong

    sizes = [(F.col(s), mip_size(F.col(f"first_{s}"), first_mip)) for s in ("width", "height", "depth")]
    counts = [(F.col(n), F.col(f"first_{n}")) for n in ("n_layers", "n_faces", "n_mips")]
    checks = {
        "size": (differs(*sizes), F.concat_ws("x", "width", "height", "depth")),
        "counts": (differs(*counts), F.concat_ws("x", "n_layers", "n_faces", "n_mips")),
    }
    for field in ("format", "alpha_mode", "color_transform"):
        checks[field] = (differs((F.col(field), F.col(f"first_{field}"))), F.col(field))
    return checks


def _is_checked() -> Column:
    """Whether a part stands for its file, and the file isn't the first of its base."""
    return (F.col("layer") == 0) & (F.col("face") == 0) & (F.col("mip") == 0) & ~_is_first()


def stitch_errors(parts: DataFrame, firsts: DataFrame | None = None) -> DataFrame:
    """Files that disagree with the first file of their base, one row per fault.

    Compared are the size expected at the file's first mip, the part counts, the
    format, the alpha mode and the colour transform. Dimension, normal flag and
    user version may differ.
    """
    faults = [
        F.when(wrong, F.struct(F.lit(code).alias("code"), detail.alias("detail")))
        for code, (wrong, detail) in _checks().items()
    ]
    return (
        _with_first(parts, firsts).filter(_is_checked())
        .withColumn("_fault", F.explode(F.array_compact(F.array(*faults))))
        .select("base", "file", *FILE_KEYS, "_fault.*")
    )


def _limit_faults() -> list[Column]:
    totals = {
        axis: F.col(f"first_n_{axis}s").cast("bigint") * F.col(f"{axis}_files") for axis in ("layer", "face", "mip")
    }
    faults = [
        F.when(total > MAX_INDEX, F.struct(F.lit(f"too_many_{axis}s").alias("code"), total.alias("total")))
        for axis, total in totals.items()
    ]
    too_many = (totals["face"] > MAX_FACES) & (totals["face"] <= MAX_INDEX)
    return [*faults, F.when(too_many, F.struct(F.lit("too_many_faces").alias("code"), totals["face"].alias("total")))]


def stitch_limits(parts: DataFrame, firsts: DataFrame | None = None) -> DataFrame:
    """Bases whose joined texture would exceed an index or face limit."""
    firsts = _first_files(parts) if firsts is None else firsts
    return firsts.withColumn("_fault", F.explode(F.array_compact(F.array(*_limit_faults())))).select("base", "_fault.*")


def cube_flags(faces: Column, positive_x: int, strict: bool = False) -> Column:
    """Flags of the first ``faces`` cube faces, given the flag of the first.

    A texture with one face is no cube: 0, unless ``strict`` asks for the formula.
    """
    flags = (F.call_function("shiftleft", F.lit(1), faces) - 1) * positive_x
    return flags if strict else F.when(faces == 1, 0).otherwise(flags)


def stitch(parts: DataFrame, firsts: DataFrame | None = None) -> DataFrame:
    """Subresources of the joined textures, under their global indices."""
    return _placed(_with_first(parts, firsts))


def _placed(joined: DataFrame) -> DataFrame:
    places = {
        axis: F.col(f"first_n_{axis}s").cast("bigint") * F.col(f"{axis}_file") + F.col(axis)
        for axis in ("layer", "face", "mip")
    }
    return joined.withColumns(places).drop(*[f"first_{h}" for h in HEADER], *EXTENTS)


def first_files(parts: DataFrame) -> DataFrame:
    """Extents and first-file headers, one row per base, written once for reuse.

    Hand it to several checks of the same parts as ``firsts``.
    """
    return cut_lineage(_first_files(parts))


def stitch_faults(parts: DataFrame, firsts: DataFrame | None = None) -> DataFrame:
    """All faults as (base, code): missing places, disagreeing files, limits."""
    firsts = first_files(parts) if firsts is None else firsts
    return (
        stitch_missing(parts, firsts)
        .select("base", F.lit("missing").alias("code"))
        .unionByName(stitch_errors(parts, firsts).select("base", "code"))
        .unionByName(stitch_limits(parts, firsts).select("base", "code"))
    )


def stitch_clean(parts: DataFrame) -> DataFrame:
    """Joined textures of the bases without any fault.

    One join of the parts to their first files serves the checks and the result. Checks only need to
    know whether there is a fault: the bits of a base's grid are counted, and its files' faults or-ed.
    """
    joined = _with_first(parts, _first_files(parts))
    wrong = F.lit(False)
    for fault, _ in _checks().values():
        wrong = wrong | fault
    limits = F.array_compact(F.array(*_limit_faults()))
    words = _grid_words(joined, F.bool_or((_is_checked() & wrong) | (F.size(limits) > 0)).alias("_wrong"))
    bases = words.groupBy("base", *EXTENTS).agg(F.sum(F.expr("bit_count(_bits)")).alias("_n"), F.bool_or("_wrong").alias("_wrong"))
    clean = bases.filter(F.expr(f"_n = {GRID_SIZE} AND NOT _wrong")).select("base")
    return _placed(joined.join(clean, "base", "left_semi"))
