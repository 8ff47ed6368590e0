"""Nearest neighbours by largest inner product, through a hierarchical k-means tree.

The tree is fitted on a bounded sample (`SAMPLE` vectors, those of smallest hash): k-means splits a
node into `BRANCHES`, its parts again, until parts are small. Every vector is then indexed in the leaf that it
descends to. Vectors get one more component, which makes all norms equal; the nearest
vectors by distance are then those of largest inner product.

A query walks the tree best bin first: a priority queue holds unopened branches by distance
from the query to their centroids; the nearest is opened until enough leaves are. How many leaves is
calibrated: for `CALIBRATION` queries, the true neighbours are found in all rows, and
visits widen until the wanted share of these neighbours is in visited leaves. A query whose leaves hold fewer
other vectors than it asks for walks on until they do.

Leaves are laid out one after another and cut into slots of about `SLOT` vectors, so that no
task holds more than a slot's vectors, whatever their distribution: small leaves share a slot, a large one spans several.
Queries stream past the slots of leaves they visit, and are scored against the vectors of these leaves only.
Scores are inner products of the original vectors in double precision.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part,
nor do those of another length than most; equal scores are ordered by id; rows of one id are
candidates each, but for a query's own id; a table of one vector gives no rows, nor does an empty one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from texelframe.llm.common import ranges, stored
from texelframe.llm.vectors import matrix, usable

SAMPLE = 20_000
BRANCHES = 16
LEAF = 48  # sampled vectors; parts that small aren't split
CALIBRATION = 100
RECALL = 0.96
SLOT = 4096  # indexed vectors that a task holds at once
SEED = 5


@dataclass
class Tree:
    """Nodes in order of creation: children[k] of a node, none for a leaf; its centroid and leaf number."""

    children: list[list[int]]
    centroids: np.ndarray
    leaf: np.ndarray
    top: float  # no indexed vector's squared norm is above

    @property
    def n_leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def raised(self, x: np.ndarray) -> np.ndarray:
        """Vectors with the component that makes their squared norms equal to top."""
        return np.column_stack([x, np.sqrt(np.maximum(self.top - (x * x).sum(axis=1), 0.0))])

    def descend(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each raised vector."""
        at, out = [(0, np.arange(len(x)))], np.zeros(len(x), dtype=np.int64)
        while at:
            node, rows = at.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
            elif len(rows):
                kids = np.array(self.children[node])
                nearest = np.argmin(_distances(x[rows], self.centroids[kids]), axis=1)
                at += [(int(kids[k]), rows[nearest == k]) for k in range(len(kids))]
        return out

    def visits(self, q: np.ndarray, n: int, sizes: np.ndarray, least: int) -> list[np.ndarray]:
        """For each raised query, its first n leaves, best bin first, and more until they hold `least` vectors. sizes: of leaves."""
        d = _distances(q, self.centroids)
        out = []
        for row in d:
            queue, found, held = [(0.0, 0)], [], 0
            while queue and (len(found) < n or held < least):
                _, node = heapq.heappop(queue)
                if not self.children[node]:
                    found.append(self.leaf[node])
                    held += sizes[self.leaf[node]]
                for k in self.children[node]:
                    heapq.heappush(queue, (row[k], k))
            out.append(np.array(found, dtype=np.int64))
        return out


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (centroids * centroids).sum(axis=1)[None, :] - 2 * x @ centroids.T


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """Centroids; k-means++ starts, empty parts dropped."""
    centroids = [x[rng.integers(len(x))]]
    nearest = ((x - centroids[0]) ** 2).sum(axis=1)
    while len(centroids) < k and nearest.sum() > 1e-12:
        centroids.append(x[rng.choice(len(x), p=nearest / nearest.sum())])
        nearest = np.minimum(nearest, ((x - centroids[-1]) ** 2).sum(axis=1))
    c = np.array(centroids)
    for _ in range(rounds):
        part = np.argmin(_distances(x, c), axis=1)
        kept = np.unique(part)
        c = np.array([x[part == p].mean(axis=0) for p in kept])
    return c


def fit_tree(x: np.ndarray, top: float, branches: int = BRANCHES, leaf: int = LEAF, seed: int = SEED) -> Tree:
    """x: the sample."""
    rng = np.random.default_rng(seed)
    tree = Tree([[]], np.zeros((1, x.shape[1] + 1)), np.zeros(0), top)
    x = tree.raised(x)
    centroids, work = [x.mean(axis=0)], [(0, np.arange(len(x)))]
    while work:
        node, rows = work.pop()
        if len(rows) <= leaf:
            continue
        c = _kmeans(x[rows], branches, rng)
        if len(c) < 2:  # equal vectors
            continue
        part = np.argmin(_distances(x[rows], c), axis=1)
        for k in range(len(c)):
            tree.children.append([])
            centroids.append(c[k])
            tree.children[node].append(len(tree.children) - 1)
            work.append((len(tree.children) - 1, rows[part == k]))
    is_leaf = np.array([not c for c in tree.children])
    tree.leaf = np.where(is_leaf, np.cumsum(is_leaf) - 1, -1)
    tree.centroids = np.array(centroids)
    return tree


def _best(
    scores: np.ndarray, ids: np.ndarray, x: np.ndarray, q: np.ndarray, own: int, n: int, at: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of a query's n best of the candidates, ties to the smaller id. at: their places in x, if these aren't all in order."""
    if len(scores) > n + 1:
        # summing in another order may turn nearly equal scores round: those within reach are scored again
        limit = np.partition(scores, len(scores) - n - 1)[len(scores) - n - 1]
        near = np.flatnonzero(scores >= limit - 1e-9 * max(1.0, abs(limit)))
    else:
        near = np.arange(len(scores))
    near = near[ids[near] != own]
    exact = (x[near if at is None else at[near]] * q[None, :]).sum(axis=1)
    order = np.lexsort((ids[near], -exact))[:n]
    return ids[near][order], exact[order]


class _Slot:
    """Indexed vectors in the order of their leaves."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, leaves: np.ndarray):
        order = np.argsort(leaves, kind="stable")
        self.x, self.ids = x[order], ids[order]
        self.leaves, self.starts, self.sizes = np.unique(leaves[order], return_index=True, return_counts=True)

    def best(self, q: np.ndarray, own: np.ndarray, open_: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of each query's n best of the vectors in the leaves it opened. A leaf is scored for all that opened it at once."""
        visitor = np.repeat(np.arange(len(q)), [len(o) for o in open_])
        leaf = np.concatenate(open_)
        here = np.searchsorted(self.leaves, leaf)
        known = (here < len(self.leaves)) & (self.leaves[np.minimum(here, len(self.leaves) - 1)] == leaf)
        visitor, here = visitor[known], here[known]
        # a query's scores stand one after another, leaf by leaf
        counts = self.sizes[here]
        starts = np.cumsum(counts) - counts
        scores, rows = np.empty(int(counts.sum())), np.empty(int(counts.sum()), dtype=np.int64)
        by_leaf = np.argsort(here, kind="stable")
        edges = np.flatnonzero(np.diff(here[by_leaf], prepend=-1))
        for pairs in np.split(by_leaf, edges[1:]) if len(by_leaf) else []:
            a, m = self.starts[here[pairs[0]]], self.sizes[here[pairs[0]]]
            at = starts[pairs][:, None] + np.arange(m)
            scores[at] = q[visitor[pairs]] @ self.x[a : a + m].T
            rows[at] = np.arange(a, a + m)
        ends = np.cumsum(np.bincount(visitor, weights=counts, minlength=len(q))).astype(np.int64)
        out, begin = [], 0
        for k, (own_id, end) in enumerate(zip(own, ends.tolist())):
            if end > begin:
                at = rows[begin:end]
                near, s = _best(scores[begin:end], self.ids[at], self.x, q[k], own_id, n, at)
                out.append((np.full(len(near), own_id), near, s))
            begin = end
        if not out:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
        return tuple(np.concatenate(c) for c in zip(*out))


def _ranked(found: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n).select("query_id", "rank", "vec_id", "score")


def _true_neighbours(index: DataFrame, queries: list[tuple[int, list[float]]], n: int) -> DataFrame:
    """Exact neighbours of a bounded list of queries among all rows, with their leaves: each task keeps its n best."""
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids = [q for q, _ in shared.value]
        q = np.array([v for _, v in shared.value])
        for batch in batches:
            if not len(batch):
                continue
            x, ids = matrix(batch.column("embedding")), batch.column("vec_id").to_numpy()
            leaf = dict(zip(ids.tolist(), batch.column("leaf").to_pylist()))
            scores = q @ x.T
            for k, own in enumerate(q_ids):
                near, s = _best(scores[k], ids, x, q[k], own, n)
                columns = [np.full(len(near), own), near, s, np.array([leaf[i] for i in near.tolist()], dtype=np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score", "leaf"])

    found = index.select("vec_id", "leaf", "embedding").mapInArrow(run, "query_id long, vec_id long, score double, leaf long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n).select("query_id", "vec_id", "leaf")


def needed_visits(tree: Tree, queries: list[tuple[int, list[float]]], truth: list[tuple[int, int]], recall: float) -> int:
    """Leaves to visit so that the wanted share of true (query, leaf of neighbour) is reached."""
    if not truth:
        return tree.n_leaves
    ids = [q for q, _ in queries]
    x = np.column_stack([np.array([v for _, v in queries]), np.zeros(len(queries))])
    place = {}
    for q, order in zip(ids, tree.visits(x, tree.n_leaves, np.ones(tree.n_leaves), 0)):
        place[q] = np.empty(tree.n_leaves, dtype=np.int64)
        place[q][order] = np.arange(len(order))
    ranks = np.sort([place[q][leaf] for q, leaf in truth])
    return int(ranks[min(int(np.ceil(recall * len(ranks))), len(ranks)) - 1]) + 1


def nearest(
    vectors: DataFrame, is_query: Column, n: int = 20, sample: int = SAMPLE, calibration: int = CALIBRATION, recall: float = RECALL,
    branches: int = BRANCHES, leaf: int = LEAF, seed: int = SEED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's n nearest found of all vectors of (vec_id, embedding) but its own."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    lengths = rows.groupBy(F.size("embedding").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)).alias("top")
    )
    most = lengths.orderBy(F.desc("n"), "d").first()  # one row per length
    if most is None:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.size("embedding") == most.d)
    taken = rows.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(sample).select("embedding").toPandas()
    tree = fit_tree(np.array(taken.embedding.tolist(), dtype=np.float64), most.top * (1 + 1e-12), branches, leaf, seed)
    shared = spark.sparkContext.broadcast(tree)  # bounded by the sample

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        for batch in batches:
            found = tree.descend(tree.raised(matrix(batch.column("embedding"))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, "leaf"])

    index = stored(rows.mapInArrow(place, "vec_id long, embedding array<double>, leaf long"))
    sizes = np.zeros(tree.n_leaves, dtype=np.int64)
    for r in index.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect():  # a row per leaf
        sizes[r.leaf] = r.n
    # leaves along a line of all vectors, cut into slots
    first = np.cumsum(sizes) - sizes
    asked = rows.filter(is_query)
    trial = [(r.vec_id, list(r.embedding)) for r in asked.orderBy(F.xxhash64("vec_id", F.lit(seed + 1)), "vec_id").limit(calibration).collect()]
    truth = [(r.query_id, r.leaf) for r in _true_neighbours(index, trial, n).collect()] if trial else []
    visits = needed_visits(tree, trial, truth, recall)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        for batch in batches:
            if not len(batch):
                continue
            q = matrix(batch.column("embedding"))
            rows, slots, leaves = [], [], []
            # one of a leaf's vectors may be the query itself
            for k, order in enumerate(tree.visits(np.column_stack([q, np.zeros(len(q))]), visits, sizes, n + 1)):
                order = order[sizes[order] > 0]
                lo, hi = first[order] // SLOT, (first[order] + sizes[order] - 1) // SLOT
                slot, leaf = ranges(lo, hi - lo + 1), np.repeat(order, hi - lo + 1)
                by_slot = np.argsort(slot, kind="stable")
                slot, leaf = slot[by_slot], leaf[by_slot]
                cuts = np.flatnonzero(np.diff(slot, prepend=-1))
                rows += [k] * len(cuts)
                slots += slot[cuts].tolist()
                leaves += [x.tolist() for x in np.split(leaf, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(rows)), batch.column("embedding").take(pa.array(rows)), pa.array(slots, pa.int64()), pa.array(leaves, pa.list_(pa.int64()))],
                names=["vec_id", "embedding", "slot", "leaves"],
            )

    walked = asked.mapInArrow(walk, "vec_id long, embedding array<double>, slot long, leaves array<long>")
    line = F.broadcast(spark.createDataFrame([(k, int(f), int(m)) for k, (f, m) in enumerate(zip(first, sizes))], "leaf long, first long, size long"))  # a row per leaf
    place_of = F.col("first") + F.pmod(F.xxhash64("at"), F.col("size"))
    items = index.withColumn("at", F.monotonically_increasing_id()).join(line, "leaf").select(F.floor(place_of / SLOT).alias("slot"), F.lit(0).alias("kind"), "vec_id", "embedding", F.array("leaf").alias("leaves"))
    passing = walked.select("slot", F.lit(1).alias("kind"), "vec_id", "embedding", "leaves")
    dealt = items.union(passing).repartition("slot").sortWithinPartitions("slot", "kind", "vec_id")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, slot = None, [], None
        for batch in batches:
            if not len(batch):
                continue
            key, kind = batch.column("slot").to_numpy(), batch.column("kind").to_numpy()
            edges = [0, *(np.flatnonzero((np.diff(key) != 0) | (np.diff(kind) != 0)) + 1).tolist(), len(key)]
            for a, b in zip(edges, edges[1:]):
                if key[a] != at:
                    at, held, slot = key[a], [], None
                part = batch.slice(a, b - a)
                x, own = matrix(part.column("embedding")), part.column("vec_id").to_numpy()
                seen = part.column("leaves")
                if kind[a] == 0:
                    held.append((x, own, seen.flatten().to_numpy()))
                    continue
                if not held:
                    continue
                if slot is None:
                    slot = _Slot(*(np.concatenate(c) for c in zip(*held)))
                for lo in range(0, len(x), 256):
                    found = slot.best(x[lo : lo + 256], own[lo : lo + 256], [v.values.to_numpy() for v in seen[lo : lo + 256]], n)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["query_id", "vec_id", "score"])

    return _ranked(dealt.mapInArrow(search, "query_id long, vec_id long, score double"), n).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
