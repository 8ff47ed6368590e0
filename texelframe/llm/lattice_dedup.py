"""Near-duplicate vectors by lattice hashing.

Unit vectors are projected at random to `BLOCKS` times eight dimensions in each of `TABLES` tables;
each block is decoded to the nearest point of the E8 lattice, and the points together are the vector's
cell. A vector stands in its own cell and probes the `PROBES` neighbouring cells (a root of the
lattice away in one block) that are nearest to it. Those that meet are candidates; 128 signs of random projections, compared
by bits within the join, leave hardly any but real neighbours, whose cosine is then computed in
double precision. Two vectors of cosine 0.9 meet in a table with probability of about one half,
in one of twelve with 0.9998; the nearer they are, the likelier.

Equal vectors are one class from the start, so that copies are counted and not paired.

Defined results: vectors that are null, zero, or hold null or non-finite components have no link and
are components of their own; vectors of different lengths have none with each other; repeated rows of
one id count once if their vectors are equal, else with the links of both; a null id takes part in
nothing; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from texelframe.llm.common import stored
from texelframe.llm.components import connected_components
from texelframe.llm.lattice import nearest_e8, roots
from texelframe.llm.vectors import by_length, matrix, usable

THRESHOLD = 0.9
TABLES = 12
BLOCKS = 2
PROBES = 8
WIDTH = 2.4
MAX_BITS = 42  # of 128 that may differ: 18 do at cosine 0.9, with a deviation of 4; 64 at random
SEED = 11


def cells(x: np.ndarray, table: int, blocks: int, width: float, probes: int, seed: int) -> np.ndarray:
    """For each unit vector, the keys of its own cell (first) and of the cells it probes."""
    n, d = x.shape
    rng = np.random.default_rng([seed, table, d])
    project, shift = rng.normal(size=(d, 8 * blocks)) / width, rng.uniform(0, 2, size=8 * blocks)
    points = (x @ project + shift).reshape(-1, 8)
    near = nearest_e8(points)
    v = roots()
    gain = ((points - near) @ v.T).reshape(n, -1)
    best = np.argsort(-gain, axis=1, kind="stable")[:, :probes]
    near = near.reshape(n, blocks, 8)
    out = np.empty((n, 1 + probes), dtype=np.int64)
    head = f"{table}/{d}".encode()
    for k in range(1 + probes):
        cell = near
        if k:
            cell = near.copy()
            cell[np.arange(n), best[:, k - 1] // len(v)] += v[best[:, k - 1] % len(v)]
        coordinates = np.rint(cell.reshape(n, -1) * 2).astype(np.int16)
        out[:, k] = [xxhash.xxh3_64_intdigest(head + c.tobytes()) - (1 << 63) for c in coordinates]
    return out


def signs(x: np.ndarray, seed: int) -> np.ndarray:
    """128 signs of random projections of each vector, as two 64-bit words."""
    rng = np.random.default_rng([seed, 1 << 20, x.shape[1]])
    bits = (x @ rng.normal(size=(x.shape[1], 128)) > 0).astype(np.uint8)
    return np.packbits(bits, axis=1).view(">i8").astype(np.int64)


def places(classes: DataFrame, tables: int, blocks: int, width: float, probes: int, seed: int) -> DataFrame:
    """(rep, key, own, s0, s1): every class in the cells that it stands in or probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in by_length(batch.column("embedding")):
                x = x / np.abs(x).max(axis=1)[:, None]  # so that squares neither overflow nor vanish
                x = x / np.linalg.norm(x, axis=1)[:, None]
                s = signs(x, seed)
                reps = batch.column("rep").take(pa.array(rows)).to_numpy()
                for t in range(tables):
                    keys = cells(x, t, blocks, width, probes, seed)
                    m = keys.shape[1]
                    columns = [np.repeat(reps, m), keys.reshape(-1), np.tile(np.arange(m) == 0, len(x)), np.repeat(s[:, 0], m), np.repeat(s[:, 1], m)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["rep", "key", "own", "s0", "s1"])

    return classes.select("rep", "embedding").mapInArrow(run, "rep long, key long, own boolean, s0 long, s1 long")


def verified(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Those (a, b) of pairs whose cosine, in double precision, reaches the threshold."""
    each = pairs.join(classes.select(F.col("rep").alias("a"), F.col("embedding").alias("x")), "a")
    each = each.join(classes.select(F.col("rep").alias("b"), F.col("embedding").alias("y")), "b").filter(F.size("x") == F.size("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(len(batch), dtype=bool)
            for rows, x in by_length(batch.column("x")):
                y = matrix(batch.column("y").take(pa.array(rows)))
                x, y = x / np.abs(x).max(axis=1)[:, None], y / np.abs(y).max(axis=1)[:, None]
                keep[rows] = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1)) >= threshold
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return each.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES, blocks: int = BLOCKS, width: float = WIDTH,
    probes: int = PROBES, max_bits: int = MAX_BITS, seed: int = SEED,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector of (vec_id, embedding)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.dropDuplicates(["vec_id", "embedding"])
    good = rows.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    classes = stored(good.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")))
    placed = stored(places(classes, tables, blocks, width, probes, seed))
    a = placed.select("key", F.col("rep").alias("a"), F.col("own").alias("own_a"), F.col("s0").alias("a0"), F.col("s1").alias("a1"))
    b = placed.filter("own").select("key", F.col("rep").alias("b"), F.col("s0").alias("b0"), F.col("s1").alias("b1"))
    apart = F.bit_count(F.col("a0").bitwiseXOR(F.col("b0"))) + F.bit_count(F.col("a1").bitwiseXOR(F.col("b1")))
    meet = (F.col("a") != F.col("b")) & (~F.col("own_a") | (F.col("a") < F.col("b"))) & (apart <= max_bits)
    pairs = a.join(b, "key").filter(meet).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = stored(verified(pairs, classes, threshold))
    sizes = classes.select(F.col("rep").alias("other"), "n")
    both = links.select(F.col("a").alias("rep"), F.col("b").alias("other")).union(links.select("b", "a"))
    linked = both.join(sizes, "other").groupBy("rep").agg(F.sum("n").alias("others"))
    parts = connected_components(links).withColumnRenamed("node", "rep")
    known = classes.join(linked, "rep", "left").join(parts, "rep", "left").select(
        "embedding", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    found = good.join(known, "embedding").select("vec_id", "n_links", "component_id")
    out = rows.select("vec_id").distinct().join(found.groupBy("vec_id").agg(F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id")), "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
