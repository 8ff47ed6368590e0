"""Jaccard self-join of documents on sets of word shingles, and its connected components.

1. Every text becomes the set of 64-bit hashes of its distinct shingles. Documents of equal sets are
   one class from here on, represented by the smallest id.
2. Tiles. Sizes are cut into bands, each as wide as two sets that link can differ in size, so that a set's
   partners of its own size or more are in its own band or the next. A tile belongs to a band: it holds sets of that band (its
   hosts) and of the one below (its guests), and every pair with a host is one to look at. Tiles of size bands alone
   would compare all documents of like size. So a band's sets are dealt to tiles by a number of keys, each of the
   smallest shingles by several hash orders; how many is worked out from the threshold, so that a linked
   pair shares none of them with probability below `MISSED` (see `layout`). Common passages, being only
   a part of their documents, don't fill a tile.
3. Signatures. Each class carries a bitmap of its hashed shingles. Bits set in one bitmap
   and not in the other count shingles that aren't shared: they bound the overlap from above,
   and pairs that can't reach the threshold, by sizes or by bits, go. Very large sets have only a part of their shingles
   in the bitmap; where two sets differ in that part, sizes alone bound the overlap.
4. The sets of remaining pairs are compared exactly, as sorted arrays. First every class with one
   host of a tile only, for most are linked by that; components of these links are formed; then all
   pairs within a tile that are still in different components. So a large group of near copies
   costs a comparison for each member instead of each pair, and no link between components is lost.
   A family of documents that are alike without being linked remains: its pairs grow with its square. Their
   bitmaps are compared as arrays, and a set is sent to each block of such a family, not to each of its pairs.

Defined results: a text without words (null, empty, blank) has no shingle and no partner; rows of the
same id count as one document, with the union of their links, each with its own number of shingles; a null id takes
part in nothing and has no component; other columns are ignored, whatever their names; a text may be of any length, as its set
is made at once; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from texelframe.llm.common import Words, ranges, release, slices, stored
from texelframe.llm.components import connected_components

SHINGLE = 5
PERCENT = 80
MISSED = 1e-9
MOST_KEYS = 50  # of a class
LEAST_PERCENT = 50
BITS = 2048
# A set is named by its class's smallest id and half of its digest, as one id may have several texts.
NAME = ("doc", "half")
TILE = 4096  # members of a tile that meet in a task at once
PAIRS = 1 << 14  # pairs whose bitmaps are compared at once
SHINGLES = 1 << 20  # of the sets that are compared at once


def _word_hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_numpy(zero_copy_only=False)), dtype=np.uint64, count=len(words))


def _mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_sets(texts: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every text as sorted hashes, one after another, and the ends of texts.

    Words are lower-cased from A to Z. A text of fewer words than `width` has one shingle, all of them.
    """
    words = Words(pc.ascii_lower(pc.fill_null(texts, "").cast(pa.large_string())))
    h = _word_hashes(words.distinct)[words.codes]
    counts = words.counts
    n_shingles = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    begin = ranges(words.starts, n_shingles)
    length = np.repeat(np.minimum(counts, width), n_shingles)
    value = length.astype(np.uint64)
    for k in range(width):
        inside = k < length
        at = np.minimum(begin + k, max(len(h) - 1, 0))
        value = np.where(inside, _mixed(value + h[at]) if len(h) else value, value)
    doc = np.repeat(np.arange(len(counts)), n_shingles)
    last = np.cumsum(n_shingles)
    for a, b in zip((last - n_shingles).tolist(), last.tolist()):
        value[a:b].sort()
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    return value[new], np.cumsum(np.bincount(doc[new], minlength=len(counts)))


def layout(percent: int) -> tuple[int, int]:
    """(keys of a class, hash orders of a key) for a threshold: the most selective keys that miss a pair with probability below MISSED.

    Two sets of similarity J share a key of r orders with probability J^r.
    """
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent must be in {LEAST_PERCENT}..100, got {percent}")
    for orders in range(8, 0, -1):
        keys = 1 if percent == 100 else math.ceil(math.log(MISSED) / math.log(1 - (percent / 100) ** orders))
        if keys <= MOST_KEYS:
            break
    return keys, orders


def tile_keys(sets: np.ndarray, ends: np.ndarray, n_keys: int, n_orders: int) -> np.ndarray:
    """For each set that isn't empty, its keys."""
    starts = np.concatenate([[0], ends[:-1]])
    full = np.flatnonzero(ends > starts)
    keys = np.empty((len(full), n_keys), dtype=np.uint64)
    if not len(full):
        return keys
    h, shifted = np.empty_like(sets), np.empty_like(sets)
    # odd multipliers of the hash orders
    orders = _mixed(np.arange(1, n_keys * n_orders + 1, dtype=np.uint64)) | np.uint64(1)
    for k in range(n_keys):
        key = np.full(len(full), k, dtype=np.uint64)
        for a in orders[k * n_orders : (k + 1) * n_orders]:
            np.multiply(sets, a, out=h)
            np.right_shift(h, np.uint64(29), out=shifted)
            h ^= shifted
            h *= np.uint64(0xBF58476D1CE4E5B9)
            key = _mixed(key + np.minimum.reduceat(h, starts[full]))
        keys[:, k] = key
    return keys


def size_band(n: Column, percent: int) -> Column:
    """Number of the band of sizes; those of two sets that can link differ by one at most."""
    width = math.log(100 / percent) * (1 + 1e-9)  # a little more, for rounding
    return F.floor(F.log(n) / width)


def fold(size: np.ndarray) -> np.ndarray:
    """Of a set of that size, one in 2^fold shingles goes into its bitmap: all of up to 1.4 for a bit, which tells most."""
    return np.maximum(np.ceil(np.log2(np.maximum(size, 1) / (BITS * 1.4))), 0).astype(np.int64)


def bitmaps(sets: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A bitmap of BITS bits of each set, as 64-bit words."""
    counts = np.diff(ends, prepend=0)
    row = np.repeat(np.arange(len(ends)), counts)
    taken = (sets >> np.uint64(40)) & ((np.uint64(1) << fold(counts).astype(np.uint64)) - np.uint64(1))[row] == 0
    bits = np.zeros((len(ends), BITS), dtype=np.uint8)
    bits[row[taken], (sets[taken] % np.uint64(BITS)).astype(np.int64)] = 1
    return np.packbits(bits, axis=1).view(">i8").astype(np.int64)


def _digests(sets: np.ndarray, ends: np.ndarray) -> list[bytes]:
    raw, edges = sets.tobytes(), (np.concatenate([[0], ends]) * 8).tolist()
    return [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(edges, edges[1:])]


def _halves(digests: list[bytes]) -> pa.Array:
    return pa.array([int.from_bytes(d[:8], "little", signed=True) for d in digests], pa.int64())


def signatures(docs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, n_shingles, digest of the set, half of it, keys, bits, fold) of every document."""
    n_keys, n_orders = layout(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets, ends = shingle_sets(part.column("text"))
                counts = np.diff(ends, prepend=0)
                of = np.concatenate([[0], np.cumsum((counts > 0) * n_keys)])
                keys = pa.ListArray.from_arrays(pa.array(of, pa.int32()), pa.array(tile_keys(sets, ends, n_keys, n_orders).reshape(-1).view(np.int64)))
                bits = pa.ListArray.from_arrays(pa.array(np.arange(len(ends) + 1) * (BITS // 64), pa.int32()), pa.array(bitmaps(sets, ends).reshape(-1)))
                digests = _digests(sets, ends)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(counts), pa.array(digests, pa.binary()), _halves(digests), keys, bits, pa.array(fold(counts))],
                    names=["doc_id", "n_shingles", "digest", "half", "keys", "bits", "fold"],
                )
        release()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, digest binary, half long, keys array<long>, bits array<long>, fold long")


def sorted_sets(docs: DataFrame) -> DataFrame:
    """(doc, half, shingles) of every document: half of its set's digest, and its sorted shingles, eight bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets, ends = shingle_sets(part.column("text"))
                raw, edges = sets.tobytes(), (np.concatenate([[0], ends]) * 8).tolist()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), _halves(_digests(sets, ends)), pa.array([raw[a:b] for a, b in zip(edges, edges[1:])], pa.binary())],
                    names=[*NAME, "shingles"],
                )
        release()

    return docs.select("doc_id", "text").mapInArrow(run, "doc long, half long, shingles binary")


def _overlap(a: str, b: str) -> Column:
    """The most that the sets of two columns of the sign kind can share, by their sizes and, if these are of one fold, their bitmaps."""
    n, m, x, y = F.col(f"{a}.n"), F.col(f"{b}.n"), F.col(f"{a}.bits"), F.col(f"{b}.bits")
    common = sum((F.bit_count(x[k].bitwiseAND(y[k])) for k in range(1, BITS // 64)), F.bit_count(x[0].bitwiseAND(y[0])))
    bound = F.least(n - F.col(f"{a}.ones") + common, m - F.col(f"{b}.ones") + common)
    return F.when(F.col(f"{a}.fold") != F.col(f"{b}.fold"), F.least(n, m)).otherwise(bound)


def _may_link(a: str, b: str, percent: int) -> Column:
    """Whether two sets can reach the threshold; sizes are compared first."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * _overlap(a, b) >= percent * (n + m))


def _named(side: str) -> list[str]:
    return [f"{side}_{c}" for c in NAME]


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those (a_doc, b_doc) of pairs of names whose sets reach the threshold exactly; sets: (doc, half, shingles)."""
    each = pairs.join(sets.toDF(*_named("a"), "left"), _named("a")).join(sets.toDF(*_named("b"), "right"), _named("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left"), batch.column("right")):
                left, right = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * both >= percent * (len(left) + len(right) - both))
            yield batch.select(["a_doc", "b_doc"]).filter(pa.array(keep, pa.bool_()))
        release()

    return each.select("a_doc", "b_doc", "left", "right").mapInArrow(run, "a_doc long, b_doc long")


def _whole_cells(batches: Iterator[pa.RecordBatch], by: tuple[str, ...]) -> Iterator[pa.Table]:
    """The rows of batches that are sorted by cells, cut between cells only. by: the columns that are equal within a cell."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = _cell_starts(batch, by)
        new[0] = bool(held) and any(batch.column(c)[0] != held[-1].column(c)[-1] for c in by)
        if new.any():
            last = int(np.flatnonzero(new)[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
            batch = batch.slice(last)
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _cell_starts(rows: pa.RecordBatch | pa.Table, by: tuple[str, ...]) -> np.ndarray:
    """For each row, whether it is the first of its cell."""
    new = np.ones(rows.num_rows, dtype=bool)
    if rows.num_rows:
        columns = [rows.column(c).to_numpy() for c in by]
        new[1:] = np.logical_or.reduce([v[1:] != v[:-1] for v in columns])
    return new


def _runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Begin and end of runs of items of about `most` in all."""
    if len(sizes):
        run = np.cumsum(sizes) // most
        edges = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(sizes)]
        yield from zip(edges, edges[1:])


BLOCK = ("family", "s", "t")


def blocks(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows of blocks of pairs: first (doc, half, shingles) of every set that a block's pairs need, then its pairs, with b_doc and b_half.

    pairs: (a_doc, a_half, a_n, b_doc, b_half, b_n, family). A family's sets are dealt to slots of about SHINGLES; two slots make a block.
    """
    end = F.explode(F.array(*(F.struct(*(F.col(f"{e}_{c}").alias(c) for c in (*NAME, "n"))) for e in "ab")))
    sizes = pairs.select("family", end.alias("end")).distinct().groupBy("family").agg(F.sum("end.n").alias("size"))
    slot = lambda e: F.pmod(F.xxhash64(*_named(e)), F.ceil(F.col("size") / SHINGLES).cast("long"))
    placed = pairs.join(sizes, "family").select("family", slot("a").alias("s"), slot("b").alias("t"), *_named("a"), *_named("b"))
    end = F.explode(F.array(*(F.struct(*(F.col(f"{e}_{c}").alias(c) for c in NAME)) for e in "ab")))
    needed = placed.select(*BLOCK, end.alias("end")).select(*BLOCK, "end.*").distinct().join(sets, [*NAME]).select(*BLOCK, *NAME, "shingles")
    compared = placed.select(*BLOCK, *(F.col(f"a_{c}").alias(c) for c in NAME), *_named("b"))
    rows = needed.unionByName(compared, allowMissingColumns=True)
    return rows.repartition(*BLOCK).sortWithinPartitions(*BLOCK, F.col("shingles").isNull())


def verified_in_blocks(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """As `verified`, for families of pairs (see `blocks`): a set is sent to a block once, however many of its pairs need it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cells in _whole_cells(batches, BLOCK):
            starts = np.flatnonzero(_cell_starts(cells, BLOCK))
            edges = np.append(starts, cells.num_rows)
            lengths = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(cells.column("shingles")), 0).to_numpy(), dtype=np.int64)])
            for a, b in _runs(np.diff(lengths[edges]), 8 * SHINGLES):
                yield _reaching(cells.slice(edges[a], edges[b] - edges[a]), percent)
        release()

    return blocks(pairs, sets).mapInArrow(run, "a_doc long, b_doc long")


def _reaching(rows: pa.Table, percent: int) -> pa.RecordBatch:
    """(a_doc, b_doc) of the pairs among rows of blocks whose sets reach the threshold."""
    given = pc.is_valid(rows.column("shingles")).to_numpy()
    doc, half = (rows.column(c).to_numpy() for c in NAME)
    place = {name: k for k, name in enumerate(zip(doc[given].tolist(), half[given].tolist()))}
    raw = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in rows.column("shingles").filter(pa.array(given))]
    sizes = np.array([len(x) for x in raw], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    codes = np.unique(np.concatenate(raw), return_inverse=True)[1]
    others = rows.filter(pa.array(~given))
    a = np.fromiter((place[x] for x in zip(doc[~given].tolist(), half[~given].tolist())), dtype=np.int64, count=others.num_rows)
    b_doc, b_half = (others.column(c).to_numpy() for c in _named("b"))
    b = np.fromiter((place[x] for x in zip(b_doc.tolist(), b_half.tolist())), dtype=np.int64, count=others.num_rows)
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    both = np.empty(len(a), dtype=np.int64)
    marks = np.zeros(len(codes), dtype=np.uint8)
    edges = [*np.flatnonzero(np.diff(a, prepend=-1)).tolist(), len(a)]
    for lo, hi in zip(edges, edges[1:]):  # the pairs of one set
        own, partners = codes[starts[a[lo]] : starts[a[lo]] + sizes[a[lo]]], b[lo:hi]
        marks[own] = 1
        counts = sizes[partners]
        both[lo:hi] = np.add.reduceat(marks[codes[ranges(starts[partners], counts)]], np.cumsum(counts) - counts, dtype=np.int64)
        marks[own] = 0
    keep = 100 * both >= percent * (sizes[a] + sizes[b] - both)
    return pa.RecordBatch.from_arrays([pa.array(doc[~given][order][keep]), pa.array(b_doc[order][keep])], names=["a_doc", "b_doc"])


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id): components of documents of at least `percent` similarity."""
    signed = stored(signatures(docs, percent))
    some = signed.filter("n_shingles > 0 and doc_id is not null")
    # a class's rows differ in their ids only
    heads = some.groupBy("digest").agg(F.min("doc_id").alias("doc"), F.first("n_shingles").alias("n"), *(F.first(c).alias(c) for c in ("half", "keys", "bits", "fold")))
    heads = stored(heads)
    classes = heads.select("digest", F.col("doc").alias("rep"))
    of_class = some.select("doc_id", "n_shingles", "digest").join(classes, "digest").select("doc_id", "n_shingles", "rep")
    empty = signed.filter("n_shingles = 0 and doc_id is not null").select("doc_id", "n_shingles", F.col("doc_id").alias("rep"))
    of_class = stored(of_class.unionByName(empty))  # empty sets are no class together
    links = _id_links(of_class)
    if percent < 100:
        links = _set_links(docs, heads, links, percent)
    parts = connected_components(links, "a_doc", "b_doc")
    # the smallest member of a class is its smallest id, so that components are those of all documents
    out = of_class.join(parts, of_class.rep == parts.node, "left").select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    alone = signed.filter("doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.unionByName(alone)


def _id_links(of_class: DataFrame) -> DataFrame:
    """Links (a_doc, b_doc) between classes that an id with several texts is in."""
    several = of_class.groupBy("doc_id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo <> hi")
    return of_class.join(several.select("doc_id", "lo"), "doc_id").filter("rep <> lo").select(F.col("rep").alias("a_doc"), F.col("lo").alias("b_doc"))


def _set_links(docs: DataFrame, heads: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """`links`, and enough of those between classes, heads, to connect all that are."""
    band = size_band(F.col("n"), percent)
    keyed = heads.select(*NAME, band.alias("band"), F.explode("keys").alias("k"))
    # most keys are of one class: these go before classes are placed in tiles
    several = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("k")
    of = F.explode(F.array(F.struct(F.col("band"), F.lit(True).alias("host")), F.struct((F.col("band") + 1).alias("band"), F.lit(False).alias("host"))))
    placed = keyed.join(several, "k").select(*NAME, "k", of.alias("of")).select(*NAME, "of.host", F.xxhash64("k", "of.band").alias("key"))
    placed = stored(placed)
    # tiles of two or more, with the host that all others are compared with first
    hosts = F.when(F.col("host"), F.col("doc"))
    tiles = placed.groupBy("key").agg(F.min(hosts).alias("first_doc"), F.min_by("half", hosts).alias("first_half"), F.count(F.lit(1)).alias("n"))
    tiles = stored(tiles.filter("n > 1 and first_doc is not null"))
    members = stored(placed.join(tiles, "key").select("key", *NAME, "host", "first_doc", "first_half", "n"))
    ones = F.aggregate("bits", F.lit(0), lambda s, x: s + F.bit_count(x))
    sign = heads.select(*NAME, F.struct("n", ones.alias("ones"), "fold", "bits").alias("sign"))
    # only classes that share a tile are compared: their sets are set apart once
    shared = members.select(F.col("doc").alias("doc_id")).distinct()
    sets = stored(sorted_sets(docs.select("doc_id", "text").join(shared, "doc_id", "left_semi")).dropDuplicates([*NAME]))
    to_first = members.filter("doc <> first_doc").select(*(F.col(c).alias(f"b_{c}") for c in NAME), *(F.col(f"first_{c}").alias(f"a_{c}") for c in NAME)).distinct()
    one = _bounded(to_first, sign, percent).groupBy(*_named("b")).agg(F.max_by(F.struct(*_named("a")), F.struct("most", -F.col("a_doc"))).alias("a"))
    one = stored(one.select("a.*", *_named("b")))
    links = links.unionByName(verified(one, sets, percent))
    found = stored(connected_components(links, "a_doc", "b_doc"))
    rest = _across(members, found, sign, percent).join(one, [*_named("a"), *_named("b")], "left_anti")
    more = stored(verified_in_blocks(stored(rest), sets, percent))
    return found.toDF("b_doc", "a_doc").unionByName(more)


def _bounded(pairs: DataFrame, sign: DataFrame, percent: int) -> DataFrame:
    """Those pairs of names that may link, with the bound of their overlap against their sizes."""
    each = pairs.join(sign.toDF(*_named("a"), "sign_a"), _named("a")).join(sign.toDF(*_named("b"), "sign_b"), _named("b"))
    share = _overlap("sign_a", "sign_b") / (F.col("sign_a.n") + F.col("sign_b.n"))
    return each.filter(_may_link("sign_a", "sign_b", percent)).select(*_named("a"), *_named("b"), share.alias("most"))


CELL = ("key", "s", "t")


def _across(members: DataFrame, found: DataFrame, sign: DataFrame, percent: int) -> DataFrame:
    """Pairs within a tile, a host in each, of different components, that may link: (a_doc, a_half, a_n, b_doc, b_half, b_n, family).

    Only tiles of more than one component have any. In these, members outside the largest
    component, which names a family, are dealt to slots of about TILE; each slot meets, slot by slot of all
    members, those of other components.
    """
    parts = found.toDF("doc", "part")
    known = members.select("key", *NAME, "host", "n").join(parts, "doc", "left").withColumn("part", F.coalesce("part", "doc"))
    mixed = known.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo <> hi")
    known = stored(known.join(mixed.select("key"), "key").join(sign, [*NAME]))
    sizes = known.groupBy("key", "part").agg(F.count(F.lit(1)).alias("size"))
    most = sizes.groupBy("key").agg(F.max(F.struct("size", "part")).alias("top"), F.sum("size").alias("all")).select(
        "key", F.col("top.part").alias("main"), (F.col("all") - F.col("top.size")).alias("others")
    )
    n_slots = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / TILE)).cast("long")
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n_slots(n) - 1)
    slot = lambda n: F.pmod(F.xxhash64(*NAME), n_slots(n))
    known = known.join(most, "key").withColumns({"outside": F.col("part") != F.col("main"), "s0": slot("others"), "t0": slot("n")})
    # a member that would be in a cell twice is there once
    place = lambda s, t, drives, meets: F.struct(s.alias("s"), t.alias("t"), drives.alias("drives"), meets.alias("meets"))
    drive = F.transform(F.filter(upto("n"), lambda t: F.col("outside")), lambda t: place(F.col("s0"), t, F.lit(True), t == F.col("t0")))
    meet = F.transform(F.filter(upto("others"), lambda s: ~F.col("outside") | (s != F.col("s0"))), lambda s: place(s, F.col("t0"), F.lit(False), F.lit(True)))
    dealt = known.withColumn("cell", F.explode(F.concat(drive, meet))).select("key", "cell.*", *NAME, "host", "part", "main", F.col("sign.n").alias("size"), "sign.ones", "sign.fold", "sign.bits")
    dealt = dealt.repartition(*CELL).sortWithinPartitions(*CELL, F.desc("meets"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cells in _whole_cells(batches, CELL):
            yield from _meetings(cells, percent)
        release()

    pairs = dealt.mapInArrow(run, "a_doc long, a_half long, a_n long, b_doc long, b_half long, b_n long, family long")
    return pairs.groupBy(*_named("a"), *_named("b")).agg(F.min("family").alias("family"), *(F.first(f"{e}_n").alias(f"{e}_n") for e in "ab"))


def _meetings(cells: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs of `_across` in some cells, whose rows that meet others come first."""
    doc, half, host, part, main, size, ones, folds = (cells.column(c).to_numpy() for c in (*NAME, "host", "part", "main", "size", "ones", "fold"))
    bits = pc.list_flatten(cells.column("bits")).to_numpy().view(np.uint64).reshape(-1, BITS // 64)
    new = _cell_starts(cells, CELL)
    cell, starts = np.cumsum(new) - 1, np.flatnonzero(new)
    meets = np.add.reduceat(cells.column("meets").to_numpy().astype(np.int64), starts)
    drive = np.flatnonzero(cells.column("drives").to_numpy())
    counts, begin = meets[cell[drive]], starts[cell[drive]]
    for x, y in _runs(counts, PAIRS):
        i, j = np.repeat(drive[x:y], counts[x:y]), ranges(begin[x:y], counts[x:y])
        # hosts meet all, guests hosts only; of two members outside the main component, the smaller drives
        once = (part[i] != part[j]) & (host[i] | host[j]) & ((part[j] == main[i]) | (doc[i] < doc[j]))
        once &= 100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])
        i, j = i[once], j[once]
        common = np.bitwise_count(bits[i] & bits[j]).sum(axis=1, dtype=np.int64)
        bound = np.minimum(size[i] - ones[i], size[j] - ones[j]) + common
        bound = np.where(folds[i] == folds[j], bound, np.minimum(size[i], size[j]))
        may = (100 + percent) * bound >= percent * (size[i] + size[j])
        i, j = i[may], j[may]
        if len(i):
            low = doc[i] < doc[j]
            a, b = np.where(low, i, j), np.where(low, j, i)
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, (doc[a], half[a], size[a], doc[b], half[b], size[b], main[a]))],
                names=["a_doc", "a_half", "a_n", "b_doc", "b_half", "b_n", "family"],
            )
