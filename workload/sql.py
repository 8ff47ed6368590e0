"""SQL building blocks for the oracle: fixtures as CTEs, curves, resampling.

Written from the definitions, independently of the library: resampling gathers
taps per output sample, pyramids go level by level, batches are a recursion.
"""

from __future__ import annotations

import math

FIXTURES = {
    "px": """
        SELECT CAST(floor(event_id / 256) AS BIGINT) AS texture_id,
               CAST(floor((event_id % 256) / 16) AS INT) AS y, CAST(event_id % 16 AS INT) AS x,
               value / 16e0 AS r, user_id / 149e0 AS g, hour(ts) / 23e0 AS b,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) / 99e0 AS a
        FROM events""",
    "px_pair": """
        SELECT texture_id, y, x, r, g, b, a,
               floor(least(1e0, greatest(0e0, r)) * 15 + 0.5e0) / 15 AS r2,
               floor(least(1e0, greatest(0e0, g)) * 15 + 0.5e0) / 15 AS g2,
               floor(least(1e0, greatest(0e0, b)) * 15 + 0.5e0) / 15 AS b2,
               floor(least(1e0, greatest(0e0, a)) * 15 + 0.5e0) / 15 AS a2
        FROM px""",
    "e": """
        SELECT vec_id, CAST(p AS INT) AS p, CAST(v AS DOUBLE) * 0.5e0 + 0.5e0 AS v
        FROM (SELECT vec_id, unnest(range(len(embedding))) AS p, unnest(embedding) AS v FROM embeddings)""",
    "hm": """
        SELECT vec_id AS texture_id, CAST(floor(p / 8) AS INT) AS y, CAST(p % 8 AS INT) AS x, v AS h FROM e""",
    "hma": "SELECT texture_id, y, x, h AS a FROM hm",
    "px4": """
        SELECT vec_id AS texture_id, CAST(floor(p / 16) AS INT) AS y, CAST(floor((p % 16) / 4) AS INT) AS x,
               max(CASE WHEN p % 4 = 0 THEN v END) AS r, max(CASE WHEN p % 4 = 1 THEN v END) AS g,
               max(CASE WHEN p % 4 = 2 THEN v END) AS b, max(CASE WHEN p % 4 = 3 THEN v END) AS a
        FROM e GROUP BY 1, 2, 3""",
    "raw": """
        SELECT vec_id AS texture_id, CAST(floor(p / 16) AS INT) AS y, CAST(floor((p % 16) / 4) AS INT) AS x,
               max(CASE WHEN p % 4 = 2 THEN q END) AS r, max(CASE WHEN p % 4 = 1 THEN q END) AS g,
               max(CASE WHEN p % 4 = 0 THEN q END) AS b, max(CASE WHEN p % 4 = 3 THEN q END) AS a
        FROM (SELECT vec_id, p, floor(v * 255 + 0.5e0) / 255 AS q FROM e) GROUP BY 1, 2, 3""",
    "files": """
        SELECT doc_id, source AS dir,
               concat('tex', CAST(doc_id AS VARCHAR),
                      CASE WHEN doc_id % 5 = 0 THEN '_rgbm' WHEN doc_id % 5 = 1 THEN '_bc3n'
                           WHEN doc_id % 5 = 2 THEN '_bc6' ELSE '' END,
                      CASE WHEN doc_id % 3 = 0 THEN '.dds' WHEN doc_id % 3 = 1 THEN '.png' ELSE '.tga' END) AS name,
               n_chars AS n_bytes
        FROM documents""",
    "parts": """
        SELECT k, texture_id, layer, face, mip, CONCAT('t', CAST(texture_id AS VARCHAR)) AS base,
               CASE WHEN k % 89 = 5 THEN 48
                    ELSE CAST(64 / (CASE mip WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 4 END) AS INT) END AS width,
               CASE WHEN k % 97 = 7 THEN 'bc1' ELSE 'bc7' END AS format,
               CASE WHEN k % 101 = 9 THEN 'premultiplied' ELSE 'straight' END AS alpha_mode,
               concat('t', CAST(texture_id AS VARCHAR), '_L', CAST(layer AS VARCHAR), '_F', CAST(face AS VARCHAR),
                      CASE WHEN k % 2 = 0 THEN '_M' ELSE '_' END, CAST(mip AS VARCHAR), '.dds') AS file
        FROM (SELECT o_orderkey AS k, CAST(floor(o_orderkey / 24) AS BIGINT) AS texture_id,
                     CAST(floor((o_orderkey % 24) / 12) AS INT) AS layer,
                     CAST(floor((o_orderkey % 12) / 3) AS INT) AS face, CAST(o_orderkey % 3 AS INT) AS mip
              FROM orders) q""",
    "parts_gaps": "SELECT * FROM parts WHERE k % 83 <> 11",
    # length of each axis up to its first gap, the other two at 0; joined to the first file
    "extents": """
        SELECT l.base, layer_files, face_files, mip_files, f.width AS first_width, f.format AS first_format,
               f.alpha_mode AS first_alpha_mode
        FROM (SELECT base, CAST(count(*) AS INT) AS layer_files FROM (
                SELECT base, layer, row_number() OVER (PARTITION BY base ORDER BY layer) - 1 AS i
                FROM parts_gaps WHERE face = 0 AND mip = 0) WHERE layer = i GROUP BY base) l
        JOIN (SELECT base, CAST(count(*) AS INT) AS face_files FROM (
                SELECT base, face, row_number() OVER (PARTITION BY base ORDER BY face) - 1 AS i
                FROM parts_gaps WHERE layer = 0 AND mip = 0) WHERE face = i GROUP BY base) c ON l.base = c.base
        JOIN (SELECT base, CAST(count(*) AS INT) AS mip_files FROM (
                SELECT base, mip, row_number() OVER (PARTITION BY base ORDER BY mip) - 1 AS i
                FROM parts_gaps WHERE layer = 0 AND face = 0) WHERE mip = i GROUP BY base) m ON l.base = m.base
        JOIN (SELECT * FROM parts_gaps WHERE layer = 0 AND face = 0 AND mip = 0) f ON l.base = f.base""",
    "px_textures": """
        SELECT texture_id, ['bc7', 'bc1a', 'bc2', 'bc5s', 'bc6', 'lumi', 'bc3_rgbm', 'rgb', 'astc_ldr_4x4', 'nonsense'][texture_id % 10 + 1] AS format,
               CASE WHEN texture_id % 3 = 0 THEN 'premultiplied' ELSE 'transparency' END AS alpha_mode,
               CASE texture_id % 4 WHEN 1 THEN TRUE WHEN 2 THEN FALSE END AS alpha, texture_id % 4 < 3 AS dither,
               CASE WHEN texture_id % 5 = 2 THEN 3 WHEN texture_id % 50 = 1 THEN 9 END AS alpha_bits, texture_id % 20 = 8 OR texture_id % 10 = 6 AS rgbm,
               max(x) + 1 AS width, max(y) + 1 AS height
        FROM px GROUP BY ALL""",
    "textures": """
        SELECT p_partkey AS texture_id, CAST(p_size * 13 + p_partkey % 7 AS INT) AS width,
               CAST(p_size * 5 + p_partkey % 11 + 1 AS INT) AS height, 1 AS depth,
               CASE WHEN p_partkey % 4 = 0 THEN 'bc1' WHEN p_partkey % 4 = 1 THEN 'bc7'
                    WHEN p_partkey % 4 = 2 THEN 'astc_ldr_6x5' ELSE 'bc4' END AS format
        FROM part""",
}
NEEDS = {
    "px_textures": ["px"], "px_pair": ["px"], "hm": ["e"], "hma": ["e", "hm"], "px4": ["e"], "raw": ["e"], "parts_gaps": ["parts"],
    "extents": ["parts", "parts_gaps"],
}


def query(body: str, *fixtures: str, ctes: list[tuple[str, str]] | None = None, recursive: bool = False) -> str:
    """A statement with the fixtures it uses, in dependency order."""
    wanted: list[str] = []
    for name in fixtures:
        for needed in [*NEEDS.get(name, []), name]:
            if needed not in wanted:
                wanted.append(needed)
    named = [(n, FIXTURES[n]) for n in wanted] + (ctes or [])
    if not named:
        return body
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(f"{n} AS ({s})" for n, s in named) + "\n" + body


def r6(expression: str) -> str:
    """Six decimals, rounded at a point no short decimal or small fraction hits."""
    return f"floor(({expression}) * 1000000e0 + 0.4142e0) / 1000000e0"


def rounded(**expressions: str) -> str:
    return ", ".join(f"{r6(e)} AS {n}" for n, e in expressions.items())


def clamp01(c: str) -> str:
    return f"least(1e0, greatest(0e0, {c}))"


def srgb_to_linear(c: str) -> str:
    return f"(CASE WHEN ({c}) <= 0.04045e0 THEN ({c}) / 12.92e0 ELSE pow((({c}) + 0.055e0) / 1.055e0, 2.4e0) END)"


def linear_to_srgb(c: str) -> str:
    return f"(CASE WHEN ({c}) <= 0.0031308e0 THEN ({c}) * 12.92e0 ELSE 1.055e0 * pow({c}, 1e0 / 2.4e0) - 0.055e0 END)"


def mirrored(curve, c: str) -> str:
    return f"(sign({c}) * {curve(f'abs({c})')})"


def unorm(c: str, bits: int) -> str:
    n = 2**bits - 1
    return f"(floor({clamp01(c)} * {n} + 0.5e0) / {n}e0)"


def peak(prefix: str = "") -> str:
    return f"greatest({prefix}r, {prefix}g, {prefix}b)"


def kernel(u: str, name: str) -> str:
    if name == "triangle":
        return f"greatest(0e0, 1e0 - abs({u}))"
    if name == "mitchell":
        d = f"abs({u})"
        near = f"(7e0 * pow({d}, 3) - 12e0 * pow({d}, 2) + 16e0 / 3e0) / 6e0"
        far = f"(-7e0 / 3e0 * pow({d}, 3) + 12e0 * pow({d}, 2) - 20e0 * {d} + 32e0 / 3e0) / 6e0"
        return f"(CASE WHEN {d} < 1 THEN {near} WHEN {d} < 2 THEN {far} ELSE 0e0 END)"
    assert name == "kaiser"
    # the Bessel function I0 by its power series, term by term
    def bessel(q: str) -> str:
        terms = [f"pow({q}, {k}) / {math.factorial(k) ** 2}e0" for k in range(1, 17)]
        return "(1e0 + " + " + ".join(terms) + ")"

    window = f"({bessel(f'(4e0 * (1e0 - ({u}) * ({u}) / 9e0))')} / {bessel('4e0')})"
    sinc = f"(CASE WHEN ({u}) = 0 THEN 1e0 ELSE sin(pi() * ({u})) / (pi() * ({u})) END)"
    return f"(CASE WHEN abs({u}) < 3 THEN {sinc} * {window} ELSE 0e0 END)"


SUPPORT = {"triangle": 1, "mitchell": 2, "kaiser": 3}


def _axis_taps(name: str, filter: str, sizes: str, n: str, out: str, wrap: str) -> tuple[str, str]:
    """CTE: for each size pair and output place d, the source index i and its weight."""
    pairs = f"(SELECT DISTINCT {n} AS n, {out} AS o FROM {sizes})"
    places = f"(SELECT n, o, unnest(range(0, o)) AS d FROM {pairs})"
    if filter == "box":
        body = f"""
            SELECT n, o, d, i, (least((i + 1) * o, (d + 1) * n) - greatest(i * o, d * n)) * 1e0 AS w
            FROM (SELECT *, unnest(range(0, n)) AS i FROM {places})
            WHERE least((i + 1) * o, (d + 1) * n) > greatest(i * o, d * n)"""
        return name, body
    s = SUPPORT[filter]
    source = "greatest(0, least(n - 1, j))" if wrap == "clamp" else "((j % n) + n) % n"
    spread = f"{s} * greatest(1e0, n / o)"
    u = "(((j + 0.5e0) * o / n - 0.5e0 - d) * least(1e0, n / o))"
    body = f"""
        SELECT n, o, d, {source} AS i, {kernel('u', filter)} AS w
        FROM (SELECT *, {u} AS u FROM (
            SELECT n, o, d, unnest(range(CAST(floor((d + 0.5e0) * n / o - {spread}) AS BIGINT) - 1,
                                   CAST(ceil((d + 0.5e0) * n / o + {spread}) AS BIGINT) + 2)) AS j FROM {places}))
        WHERE abs(u) <= {s}"""
    return name, body


def resize_ctes(
    prefix: str, source: str, filter: str, channels: str = "rgba", out: tuple[str, str] | None = None,
    wrap: str = "clamp", where: str = "TRUE", keys: str = "texture_id",
) -> list[tuple[str, str]]:
    """CTEs ending in ``prefix``: source resampled to ``out``, or to half when None."""
    ow, oh = out or ("greatest(1, n_w // 2)", "greatest(1, n_h // 2)")
    sizes = (f"{prefix}_s", f"""
        SELECT *, CAST({ow} AS INT) AS o_w, CAST({oh} AS INT) AS o_h
        FROM (SELECT {keys}, max(x) + 1 AS n_w, max(y) + 1 AS n_h FROM {source} GROUP BY {keys}) WHERE {where}""")
    if filter in ("min", "max"):
        cells = ", ".join(f"{filter}({c}) AS {c}" for c in channels)
        return [sizes, (prefix, f"""
            SELECT {keys}, CAST(least(y // 2, o_h - 1) AS INT) AS y, CAST(least(x // 2, o_w - 1) AS INT) AS x, {cells}
            FROM {source} JOIN {prefix}_s USING ({keys}) GROUP BY ALL""")]
    tx = _axis_taps(f"{prefix}_tx", filter, f"{prefix}_s", "n_w", "o_w", wrap)
    ty = _axis_taps(f"{prefix}_ty", filter, f"{prefix}_s", "n_h", "o_h", wrap)
    if filter == "box":
        mean = ", ".join(f"sum(tx.w * ty.w * {c}) / sum(tx.w * ty.w) AS {c}" for c in channels)
        return [sizes, tx, ty, (prefix, f"""
            SELECT {keys}, CAST(ty.d AS INT) AS y, CAST(tx.d AS INT) AS x, {mean}
            FROM {source} JOIN {prefix}_s USING ({keys})
            JOIN {prefix}_tx tx ON tx.n = n_w AND tx.o = o_w AND tx.i = x
            JOIN {prefix}_ty ty ON ty.n = n_h AND ty.o = o_h AND ty.i = y
            GROUP BY {keys}, ty.d, tx.d""")]
    mean = ", ".join(f"sum(w * {c}) / sum(w) AS {c}" for c in channels)
    across = (f"{prefix}_x", f"""
        SELECT {keys}, y, CAST(d AS INT) AS x, {mean}
        FROM {source} JOIN {prefix}_s USING ({keys}) JOIN {prefix}_tx t ON t.n = n_w AND t.o = o_w AND t.i = x
        GROUP BY {keys}, y, d""")
    down = (prefix, f"""
        SELECT {keys}, CAST(d AS INT) AS y, x, {mean}
        FROM {prefix}_x JOIN {prefix}_s USING ({keys}) JOIN {prefix}_ty t ON t.n = n_h AND t.o = o_h AND t.i = y
        GROUP BY {keys}, d, x""")
    return [sizes, tx, ty, across, down]


def chain_ctes(
    prefix: str, start: str, filter: str, levels: int, channels: str = "rgba", step=None
) -> tuple[list[tuple[str, str]], list[str]]:
    """CTEs of a level-by-level chain; returns them and the names of levels 1.. ``levels``."""
    ctes, names, source = [], [], start
    for k in range(1, levels + 1):
        name = f"{prefix}{k}"
        ctes += resize_ctes(name, source, filter, channels, where="n_w > 1 OR n_h > 1")
        if step is not None:
            ctes.append((f"{name}n", step(name)))
            name = f"{name}n"
        names.append(name)
        source = name
    return ctes, names


def normalized(source: str) -> str:
    """Renormalised packed normals, as a SELECT over source."""
    length = "sqrt(pow(2*r-1, 2) + pow(2*g-1, 2) + pow(2*b-1, 2))"
    fixed = {"r": "0.5e0", "g": "0.5e0", "b": "1e0"}
    out = ", ".join(
        f"CASE WHEN {length} > 0 THEN (2*{c}-1) / {length} * 0.5e0 + 0.5e0 ELSE {v} END AS {c}" for c, v in fixed.items()
    )
    return f"SELECT texture_id, y, x, {out}, a FROM {source}"


def normal_map_ctes(prefix: str, source: str, weights, wrap: str = "clamp") -> list[tuple[str, str]]:
    """Slopes and signed normals of the height in column a."""
    def wrapped(position: str, n: str) -> str:
        return f"greatest(0, least({n} - 1, {position}))" if wrap == "clamp" else f"((({position}) % {n}) + {n}) % {n}"

    taps = " UNION ALL ".join(
        f"SELECT {s * k} AS o, {s}e0 * {w!r} / {2 * k}e0 AS w" for k, w in enumerate(weights, 1) for s in (1, -1)
    )
    sized = f"""SELECT p.*, n_w, n_h FROM {source} p JOIN (
        SELECT texture_id, max(x) + 1 AS n_w, max(y) + 1 AS n_h FROM {source} GROUP BY 1) USING (texture_id)"""
    return [
        (f"{prefix}_taps", taps),
        (f"{prefix}_p", sized),
        (f"{prefix}_s", f"""
            SELECT p.texture_id, p.y, p.x, any_value(p.a) AS a, sum(t.w * qx.a) AS sx, sum(t.w * qy.a) AS sy
            FROM {prefix}_p p CROSS JOIN {prefix}_taps t
            JOIN {source} qx ON qx.texture_id = p.texture_id AND qx.y = p.y AND qx.x = {wrapped('p.x + t.o', 'p.n_w')}
            JOIN {source} qy ON qy.texture_id = p.texture_id AND qy.x = p.x AND qy.y = {wrapped('p.y + t.o', 'p.n_h')}
            GROUP BY 1, 2, 3"""),
        (prefix, f"""
            SELECT texture_id, y, x, -sx / sqrt(sx*sx + sy*sy + 1) AS r, -sy / sqrt(sx*sx + sy*sy + 1) AS g,
                   1e0 / sqrt(sx*sx + sy*sy + 1) AS b, a FROM {prefix}_s"""),
    ]


def mip_count(w: str, h: str, max_mips: int, min_size: int) -> str:
    """Levels counted one by one, as an expression."""
    def side(v: str) -> str:
        return f"greatest(1, {v} >> CAST(k AS INT))"

    taken = (
        f"(SELECT count(*) FROM range(0, {max_mips}) levels(k) WHERE {side(w)} >= {min_size} AND {side(h)} >= {min_size}"
        f" AND greatest({w}, {h}) >> CAST(k AS INT) > 0)"
    )
    return f"CAST(greatest(1, {taken}) AS INT)"
