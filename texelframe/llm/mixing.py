"""Mixing sources to target weights by pivotal dependent rounding.

A source's documents are wanted target / size times each. The whole part is sure; the
fractional parts are rounded in pairs: of two documents of s and t words with probabilities p
and q, one's words are moved to the other, in random direction and with unchanged
expectation, until a probability is 0 or 1. The words expected in all, s * p + t * q, stay
the same, so that each source ends at its target but for a single document's rounding. Up to
`CORRECTIONS` documents of each source are turned round at last, where that brings it nearer.

Pairs meet in groups of hashed ids, whose number follows the number of rows; what is left
of each group, at most one document, goes up a tree of groups to the root of its source. Random
directions come from a hash of document, seed and level, each used once: reruns agree, however rows are
partitioned, and a source with most of the rows is spread over as many groups as it needs.

Rows that are equal in id, source and text are told apart by a number. Where more than `TWINS` are equal, their group is
rounded as a whole, to the number of rows that are taken once more: rows are numbered within salted blocks of
the group, and blocks one after another, so that no task holds all of it.

Defined results: a null text has size 0; documents of size 0 are taken 0 words; a null source
is a source of its own, after all others; repeated rows are rounded one by one; a null
doc_id is one like others; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from texelframe.llm.common import stored

CORRECTIONS = 3
TWINS = 1000
GROUP = 4096  # about as many documents, or residuals, meet in a group
MAX_REPEATS = 3.0
WEIGHTS = (5.0, 2.0, 1.0)


def n_words(text: Column) -> Column:
    """Number of runs of characters other than 0x20 and 0x09 to 0x0D; 0 for null."""
    blank = r"[\x20\x09-\x0D]+"
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, blank))).cast("long")


def targets(sizes: list[int], weights: list[float], most: float = MAX_REPEATS) -> list[float]:
    """Shares of sum(sizes) by weight, none above most * size; the excess goes to the others by weight."""
    out, open_ = [0.0] * len(sizes), [k for k, s in enumerate(sizes) if s > 0]
    rest = float(sum(sizes))
    while open_:
        total = math.fsum(weights[k] for k in open_)
        over = [k for k in open_ if rest * weights[k] / total > most * sizes[k]]
        if not over:
            for k in open_:
                out[k] = rest * weights[k] / total
            break
        for k in over:
            out[k] = most * sizes[k]
        rest -= math.fsum(out[k] for k in over)
        open_ = [k for k in open_ if k not in set(over)]
    return out


def _unit(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) by hash."""
    return F.shiftrightunsigned(F.xxhash64(*keys, F.lit(seed)), 11) / F.lit(float(1 << 53))


def _round_group(size: np.ndarray, p: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, int]:
    """Pivotal rounding of a group in its order; returns the probabilities, and the place of the residual or -1.

    Each number of u decides one pair: that in which its document comes second.
    """
    p = p.copy()
    held = -1
    for k in range(len(p)):
        if not 0.0 < p[k] < 1.0:
            continue
        if held < 0:
            held = k
            continue
        s, t, a, b = size[held], size[k], p[held], p[k]
        up = min((1.0 - a) * s, b * t)  # words that the held one can gain from the other
        down = min(a * s, (1.0 - b) * t)
        if u[k] * (up + down) < down:
            moved = up
            a, b = (1.0 if up == (1.0 - a) * s else a + up / s), (0.0 if up == b * t else b - up / t)
        else:
            moved = down
            a, b = (0.0 if down == a * s else a - down / s), (1.0 if down == (1.0 - b) * t else b + down / t)
        p[held], p[k] = min(max(a, 0.0), 1.0), min(max(b, 0.0), 1.0)
        if not 0.0 < p[held] < 1.0:
            held = k if 0.0 < p[k] < 1.0 else -1
    return p, held


def _level(rows: DataFrame, last: bool, seed: int, number: int) -> DataFrame:
    """Rounds within (rank, bucket); `left` marks each group's residual, which is drawn if it is the last level."""
    schema = "key long, twin long, rank int, size long, want double, p double, left boolean"
    # numbers of this level's own: one for a document's pair, another for the last draw
    rows = rows.withColumns({name: _unit(seed, F.col("key"), F.col("twin"), F.lit(number), F.lit(name)) for name in ("u", "v")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "twin", "rank", "size", "want", "p", "left"]
        held: dict | None = None

        def done(group: dict) -> pa.RecordBatch:
            p, residual = _round_group(group["size"].astype(np.float64), group["p"], group["u"])
            left = np.zeros(len(p), dtype=bool)
            if residual >= 0:
                if last:
                    p[residual] = float(group["v"][residual] < p[residual])
                else:
                    left[residual] = True
            columns = {**group, "rank": group["rank"].astype(np.int32), "p": p, "left": left}
            return pa.RecordBatch.from_arrays([pa.array(columns[c]) for c in names], names=names)

        for batch in batches:
            columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
            if held is not None:
                columns = {c: np.concatenate([held[c], columns[c]]) for c in columns}
            n = len(columns["rank"])
            if not n:
                continue
            new = np.flatnonzero((np.diff(columns["rank"]) != 0) | (np.diff(columns["bucket"]) != 0)) + 1
            for a, b in zip([0, *new[:-1]], new):
                yield done({c: x[a:b] for c, x in columns.items()})
            begin = new[-1] if len(new) else 0
            held = {c: x[begin:] for c, x in columns.items()}
        if held is not None:
            yield done(held)

    dealt = rows.repartition("rank", "bucket").sortWithinPartitions("rank", "bucket", "key", "twin")
    return dealt.select("key", "twin", "rank", "bucket", "size", "want", "p", "u", "v").mapInArrow(run, schema)


def _corrected(drawn: DataFrame) -> DataFrame:
    """drawn, with at most one document of each source turned round: the one that brings its words nearest to those wanted."""
    miss = drawn.groupBy("rank").agg(F.sum(F.col("size") * (F.col("p") - F.col("want"))).alias("miss"))
    after = F.abs(F.abs("miss") - F.col("size"))
    could = drawn.join(F.broadcast(miss), "rank").filter((F.col("p") > 0.5) == (F.col("miss") > 0)).filter(after < F.abs("miss"))
    turn = could.groupBy("rank").agg(F.min(F.struct(after.alias("after"), "key", "twin")).alias("turn"))  # a row per source
    turned = (F.col("key") == F.col("turn.key")) & (F.col("twin") == F.col("turn.twin"))
    return drawn.join(F.broadcast(turn), "rank", "left").withColumn("p", F.when(turned, 1 - F.col("p")).otherwise(F.col("p"))).drop("turn")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MAX_REPEATS, seed: int = 7) -> DataFrame:
    """docs with size, source_size, target (its source's) and copies, the number of times the mix takes it.

    Sources by code point, null last, weigh `weights` in turn, repeating. The number of
    sources must be small: a row of each reaches the driver.
    """
    spark = docs.sparkSession
    docs = docs.drop("size", "source_size", "target", "copies", *(c for c in docs.columns if c.startswith("mix_")), "ratio", "groups")
    sized = docs.withColumns({
        "size": n_words(F.col("text")),
        "mix_key": F.xxhash64(F.col("doc_id"), F.col("source"), F.col("text")),
    })
    small = stored(sized.select("mix_key", "source", "size"))  # no texts
    found = small.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    found.sort(key=lambda r: (r.source is None, (r.source or "").encode("utf-32-be")))
    wanted = targets([r.size for r in found], [weights[k % len(weights)] for k in range(len(found))], most)
    plan = spark.createDataFrame(
        [(k, r.source, r.size, t, t / r.size if r.size else 0.0, max(1, r.n // GROUP)) for k, (r, t) in enumerate(zip(found, wanted))],
        "mix_rank int, mix_source string, source_size long, target double, ratio double, groups long",
    )
    plan = F.broadcast(plan)  # a row per source
    part = F.col("ratio") - F.floor("ratio")
    # equal rows are told apart by a number; which row gets which makes no difference
    alike = Window.partitionBy("mix_key").orderBy("size")
    hot = stored(small.groupBy("mix_key").agg(F.count(F.lit(1)).alias("mix_n")).filter(F.col("mix_n") > TWINS))
    each = small.join(hot, "mix_key", "left_anti").withColumn("twin", F.row_number().over(alike).cast("long"))
    each = each.join(plan, F.col("source").eqNullSafe(F.col("mix_source"))).select(
        F.col("mix_key").alias("key"), "twin", F.col("mix_rank").alias("rank"), "size", part.alias("p"), "groups",
    )
    each = each.filter("size > 0 and p > 0").withColumn("want", F.col("p"))
    rounds = max((max(1, r.n // GROUP) for r in found), default=1)
    level = each.withColumn("bucket", F.pmod(F.xxhash64("key", "twin"), F.col("groups")))
    parts: list[DataFrame] = []
    while True:
        done = stored(_level(level, rounds <= 1, seed, len(parts)))
        parts.append(done.filter("not left").select("key", "twin", "rank", "size", "want", "p"))
        if rounds <= 1:
            break
        rounds = -(-rounds // GROUP)
        level = done.filter("left").withColumn("bucket", F.pmod(F.xxhash64("key", "twin"), F.lit(rounds)))
    ups = parts[0]
    for more in parts[1:]:
        ups = ups.union(more)
    for _ in range(CORRECTIONS):
        ups = stored(_corrected(ups))
    ups = ups.filter("p > 0.5").groupBy(F.col("key").alias("mix_key")).agg(F.collect_set("twin").alias("mix_ups"))  # TWINS at most
    cold = sized.join(hot.select("mix_key"), "mix_key", "left_anti").withColumn("mix_twin", F.row_number().over(alike).cast("long"))
    cold = cold.join(ups, "mix_key", "left").withColumn("mix_extra", F.coalesce(F.array_contains("mix_ups", F.col("mix_twin")), F.lit(False)))
    planned = lambda df: df.join(plan.drop("groups", "mix_rank"), F.col("source").eqNullSafe(F.col("mix_source")))
    drawn = F.floor(F.col("mix_n") * part + _unit(seed, F.col("mix_key")))
    groups = planned(_numbered(sized.join(hot, "mix_key"))).withColumn("mix_extra", F.col("mix_twin") <= drawn)
    columns = [*docs.columns, "size", "source_size", "target", "ratio", "mix_extra"]
    out = planned(cold).select(*columns).unionByName(groups.select(*columns))
    copies = F.when(F.col("size") > 0, F.floor("ratio") + F.col("mix_extra").cast("long")).otherwise(F.lit(0)).alias("copies")
    return out.select(*docs.columns, "size", "source_size", "target", copies)


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows of large groups of equals with mix_twin, their number from 1 in the group of their mix_key, whose size is mix_n."""
    blocks = F.ceil(F.col("mix_n") / TWINS).cast("long")
    rows = stored(rows.withColumn("mix_block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), blocks)))
    sizes = rows.groupBy("mix_key", "mix_block").agg(F.count(F.lit(1)).alias("mix_size"))
    before = F.sum("mix_size").over(Window.partitionBy("mix_key").orderBy("mix_block")) - F.col("mix_size")
    starts = sizes.select(F.col("mix_key").alias("mix_of"), F.col("mix_block").alias("mix_at"), before.alias("mix_before"))
    inside = F.row_number().over(Window.partitionBy("mix_key", "mix_block").orderBy("size"))
    placed = rows.withColumn("mix_inside", inside).join(starts, (F.col("mix_key") == F.col("mix_of")) & (F.col("mix_block") == F.col("mix_at")))
    return placed.withColumn("mix_twin", F.col("mix_inside") + F.col("mix_before"))
