"""Hard negatives by lists that the anchors of a cluster share.

Anchors are clustered by direction. For a cluster with centroid c, all of whose anchors are within the angle b of
c, no anchor u of it can score more with a candidate v than

    |u| |v| cos(max(0, angle(v, c) - b))

so that candidates sorted by |v| cos(...) once serve all anchors of the cluster: each walks the
list from its beginning and ends, with a certified result, as soon as what it holds is better than what
the next entry's bound allows. The walk is made twice. The first looks for an anchor's positives, its
best rows of the same label. The second looks for the best rows of other labels whose score is within the band that
each positive's score allows; the lowest score that any band admits ends it as well.

Candidates are dealt to chunks of about `CHUNK` rows, anchors, cluster by cluster, to groups of about `GROUP`; a
task holds a chunk and a group, and makes each list of its chunk once. Anchors are a stated set of queries, so that every group meets every
chunk; each walk returns at most as many rows as asked, and windows over these give the result. A cluster with any
share of the anchors spans as many groups as it needs. Centroids are fitted on `SAMPLE` anchors of smallest
hash at most; they decide how far walks go, not what they return.

Scores are integer inner products, computed in double precision where that is exact and in whole numbers
elsewhere; those beyond 64 bits are held at the ends of their range.

Defined results: rows without an id, label or vector, or with a null component, take no part; zero vectors do; only vectors of equal length are
compared; rows of the same id are rows of their own, but never each other's positives or negatives, and each anchor
among them has its own results; an anchor without a positive has none; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from texelframe.llm.common import stored
from texelframe.llm.vectors import by_length

CHUNK = 8192
GROUP = 4096
SAMPLE = 8192
MEMBERS = 16  # sampled anchors for a centroid
CENTROIDS = 256
STEP, MAX_STEP = 256, 2048  # entries that a walk reads at a time
SLACK = 1e-7  # of angles, more than their rounding
LEAST = np.iinfo(np.int64).min


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled to length 1 (zeros stay) and their lengths."""
    top = np.abs(x).max(axis=1, initial=0.0)  # first, so that squares stay finite
    scaled = x / np.where(top > 0, top, 1.0)[:, None]
    norm = np.sqrt((scaled * scaled).sum(axis=1))
    return scaled / np.where(norm > 0, norm, 1.0)[:, None], norm * top


def fit_centroids(x: np.ndarray, rounds: int = 8) -> np.ndarray:
    """Unit centroids of the rows' directions; the rows' order decides where they begin."""
    u, _ = _unit(x)
    n = max(1, min(CENTROIDS, len(u) // MEMBERS))
    centroids = u[np.linspace(0, len(u) - 1, n).astype(np.int64)]
    for _ in range(rounds):
        nearest = (u @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, u)
        moved, norm = _unit(sums)
        centroids = np.where(norm[:, None] > 0, moved, centroids)
    return centroids


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two matrices of whole numbers (int64)."""
    x, y = a.astype(np.float64), b.astype(np.float64)
    most = np.abs(x).max(initial=0.0) * np.abs(y).max(initial=0.0) * max(1, x.shape[1])
    if most < 2.0**53:
        return np.rint(x @ y.T).astype(np.int64)
    whole = a.astype(object) @ b.astype(object).T
    return np.clip(whole, LEAST, np.iinfo(np.int64).max).astype(np.int64)


def best(row: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row's (score, id) the k best: higher scores, of equal ones smaller ids."""
    order = np.lexsort((ids, ~score, row))
    row = row[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = row[1:] != row[:-1]
    rank = np.arange(len(row)) - np.maximum.accumulate(np.where(new, np.arange(len(row)), 0))
    order = order[rank < k]
    return row[rank < k], score[order], ids[order]


class SharedList:
    """A chunk's candidates as one cluster's anchors walk them: by falling bound."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, centroid: np.ndarray, spread: float):
        unit, norm = _unit(vectors.astype(np.float64))
        angle = np.arccos(np.clip(unit @ centroid, -1.0, 1.0))
        bound = norm * np.cos(np.maximum(0.0, angle - spread - SLACK))
        order = np.argsort(-bound, kind="stable")
        self.bound = bound[order] + np.abs(bound[order]) * 1e-9
        self.vectors, self.ids, self.labels = vectors[order], ids[order], labels[order]

    def only(self, taken: np.ndarray) -> "SharedList":
        """The entries marked, in the list's order."""
        part = object.__new__(SharedList)
        part.bound, part.vectors, part.ids, part.labels = self.bound[taken], self.vectors[taken], self.ids[taken], self.labels[taken]
        return part


def walk(entries: SharedList, vectors: np.ndarray, own: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
    """The k best entries of each anchor and band: (anchor * bands + band, score, id), scores within low..high of the band.

    low and high hold a row per anchor and a column per band; own are the anchors' ids, which are no entries
    of theirs.
    """
    m, bands = low.shape
    norm = _unit(vectors.astype(np.float64))[1]
    kth = np.full((m, bands), LEAST)  # the k-th best score held
    row, score, ids = (np.zeros(0, dtype=np.int64) for _ in range(3))
    live = np.arange(m)
    at, step = 0, STEP
    while at < len(entries.ids):
        # a band is done when all that is left scores below its range, or below what it holds
        allowed = entries.bound[at] * norm[live]
        least = np.maximum(low[live], kth[live]).astype(np.float64)
        open_ = (least <= allowed[:, None] + np.abs(allowed)[:, None] * 1e-9) & (low[live] <= high[live])
        live = live[open_.any(axis=1)]
        if not len(live):
            break
        some = slice(at, at + step)
        s = products(vectors[live], entries.vectors[some])
        other = own[live][:, None] != entries.ids[some][None, :]
        found = [(row, score, ids)]
        for band in range(bands):
            wanted = other & (s >= np.maximum(low[live, band], kth[live, band])[:, None]) & (s <= high[live, band][:, None])
            r, c = np.nonzero(wanted)
            found.append((live[r] * bands + band, s[r, c], entries.ids[some][c]))
        row, score, ids = best(*(np.concatenate(x) for x in zip(*found)), k)
        held = np.bincount(row, minlength=m * bands)
        last = np.cumsum(held)[held == k] - 1
        kth.reshape(-1)[row[last]] = score[last]
        at, step = at + step, min(2 * step, MAX_STEP)
    return row, score, ids


def _lists(chunk: pa.Table, group: pa.Table, centroids: dict[int, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, SharedList]]:
    """For each cluster and label of a group's anchors: their places in the group, their vectors, and their cluster's list of the chunk."""
    columns = {c: chunk.column(c).to_numpy() for c in ("vec_id", "label")}
    candidates = {x.shape[1]: (rows, x) for rows, x in by_length(chunk.column("vector").combine_chunks(), np.int64)} if len(chunk) else {}
    labels = group.column("label").to_numpy()
    clusters = group.column("cluster").to_numpy()
    for places, x in by_length(group.column("vector").combine_chunks(), np.int64) if len(group) else []:
        if x.shape[1] not in candidates:
            continue
        rows, vectors = candidates[x.shape[1]]
        for cluster in np.unique(clusters[places]):
            inside = np.flatnonzero(clusters[places] == cluster)
            # a length of vectors that the sample lacks has no centroid: its lists go by |v| alone
            centroid = centroids[x.shape[1]][cluster] if x.shape[1] in centroids else np.zeros(x.shape[1])
            unit, norm = _unit(x[inside].astype(np.float64))
            spread = np.arccos(np.clip(unit[norm > 0] @ centroid, -1.0, 1.0)).max(initial=0.0)
            shared = SharedList(vectors, columns["vec_id"][rows], columns["label"][rows], centroid, spread)
            for label in np.unique(labels[places[inside]]):
                own = inside[labels[places[inside]] == label]
                yield places[own], x[own], shared, label


def _anchors(rows: DataFrame) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """The anchors with their cluster and group, and the centroids by length of vector."""
    anchors = rows.filter("anchor")
    # `SAMPLE` anchors at most reach the driver
    sample = anchors.select("vector").orderBy(F.xxhash64("row")).limit(SAMPLE).toArrow().column("vector").combine_chunks()
    centroids = {x.shape[1]: fit_centroids(x) for _, x in by_length(sample)} if len(sample) else {}
    shared = rows.sparkSession.sparkContext.broadcast(centroids)  # CENTROIDS vectors for a length

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster = np.zeros(len(batch), dtype=np.int64)
            for at, x in by_length(batch.column("vector")) if len(batch) else []:
                if x.shape[1] in shared.value:
                    cluster[at] = (_unit(x)[0] @ shared.value[x.shape[1]].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cluster)], names=[*batch.schema.names, "cluster"])

    columns = anchors.select("row", "vec_id", "label", "vector")
    placed = stored(columns.mapInArrow(place, "row long, vec_id long, label int, vector array<long>, cluster long"))
    # clusters one after another along a line of all anchors, which is cut into groups
    counts = sorted((r.cluster, r.n) for r in placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect())  # CENTROIDS rows
    before = np.cumsum([0, *(n for _, n in counts)]).tolist()
    spans = [(c, b, n) for (c, n), b in zip(counts, before)]
    line = F.broadcast(rows.sparkSession.createDataFrame(spans, "cluster long, before long, n long"))
    place_of = F.col("before") + F.pmod(F.xxhash64("row"), F.col("n"))
    return placed.join(line, "cluster").withColumn("group", F.floor(place_of / GROUP)).drop("before", "n"), centroids


def _meet(rows: DataFrame, anchors: DataFrame, walk_tile, schema: str) -> DataFrame:
    """walk_tile(chunk, group) of every chunk of rows with every group of anchors."""
    n_rows = rows.count()
    last_group = anchors.agg(F.max("group")).first()[0] or 0
    n_chunks = max(1, -(-n_rows // CHUNK))
    chunk = F.pmod(F.xxhash64("row", F.lit("chunk")), F.lit(n_chunks)).alias("chunk")
    left = rows.select("vec_id", "label", "vector", chunk, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last_group).cast("long"))).alias("group"))
    right = anchors.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_chunks - 1).cast("long"))))
    return left.groupBy("chunk", "group").cogroup(right.groupBy("chunk", "group")).applyInArrow(walk_tile, schema)


def _first(df: DataFrame, n: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, lowest: int = 80) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the anchors among rows.

    rows: (vec_id long, label int, vector array<long>). For each anchor and each of its `positives` best rows of the same label, the
    `negatives` best rows of other labels that score from `lowest` percent of the positive's score up to it.
    """
    whole = F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull())
    part = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"),
        F.col("vector").cast("array<long>").alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
    ).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & whole)
    part = stored(part.withColumn("row", F.monotonically_increasing_id()))
    placed, centroids = _anchors(part)
    placed = stored(placed)
    shared = part.sparkSession.sparkContext.broadcast(centroids)

    def same_label(chunk: pa.Table, group: pa.Table) -> pa.Table:
        out = [[], [], []]
        keys, own = group.column("row").to_numpy(), group.column("vec_id").to_numpy()
        for at, x, entries, label in _lists(chunk, group, shared.value):
            any_score = np.full((len(at), 1), LEAST), np.full((len(at), 1), np.iinfo(np.int64).max)
            row, score, ids = walk(entries.only(entries.labels == label), x, own[at], *any_score, positives)
            for column, values in zip(out, (keys[at[row]], score, ids)):
                column.append(values)
        return pa.table([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in out], names=["row", "score", "id"])

    found = _first(_meet(part, placed, same_label, "row long, score long, id long"), positives, "row")
    held = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "score", "id"))).alias("held"))  # `positives` at most
    asked = stored(placed.join(held, "row"))

    def other_label(chunk: pa.Table, group: pa.Table) -> pa.Table:
        out = [[], [], [], [], []]
        keys, own = group.column("row").to_numpy(), group.column("vec_id").to_numpy()
        mine = group.column("held").to_pylist()
        high, low = np.full((len(mine), positives), LEAST), np.full((len(mine), positives), 0)
        name = np.zeros((len(mine), positives), dtype=np.int64)
        for k, entries in enumerate(mine):
            for j, e in enumerate(entries):
                high[k, j], name[k, j] = e["score"], e["id"]
                low[k, j] = max(-(-lowest * e["score"] // 100), LEAST)  # the least score that the band admits
        for at, x, entries, label in _lists(chunk, group, shared.value):
            row, score, ids = walk(entries.only(entries.labels != label), x, own[at], low[at], high[at], negatives)
            k, j = at[row // positives], row % positives
            for column, values in zip(out, (keys[k], j, name[k, j], score, ids)):
                column.append(values)
        return pa.table([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in out], names=["row", "band", "positive_id", "score", "id"])

    hard = _first(_meet(part, asked, other_label, "row long, band long, positive_id long, score long, id long"), negatives, "row", "band")
    named = asked.select("row", F.col("vec_id").alias("anchor_id"), F.col("held.score").alias("scores"))
    return hard.join(named, "row").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
        F.element_at("scores", (F.col("band") + 1).cast("int")).alias("positive_score"), F.col("score").alias("negative_score"),
    )
