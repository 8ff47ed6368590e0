"""How far the sources of a language diverge, by hash-consed segment trees over term ids.

Terms are runs of letters: A to Z, lower-cased, and every character beyond ASCII. A language keeps the terms that enough of its
documents hold. A term's smoothed share in a group of documents is

    p = 1 + floor(10^9 * (count + 2) / (N + 2 * V))

(N: the group's occurrences of kept terms, V: their number), and two shares of a term differ by
f = floor((p - q)^2 / (p + q)). Everything is whole-number arithmetic.

1. Occurrences and documents are tallied by each task, whose tallies are summed by (language, source, term).
2. Kept terms are dealt by hash to blocks of about `BLOCK` terms, fewer where a language has very many sources, so that no
   task holds more than about `CELLS` counts.
3. Within a block each source's counts, in the order of terms, are the leaves of a segment tree. Trees are hash-consed:
   equal subtrees, of whichever source and place, are one node. Two sources are compared by walking their
   trees at the same time, from the roots down; a pair of nodes that turns up again, as that of two stretches
   without any occurrence, is priced once. Sums over blocks are those over all terms.
4. Of the terms that a source uses more than its language does, each block names its best; windows rank them.

Sources of a language are compared in tiles of `TILE`, so that a task returns a bounded number of pairs.

Defined results: null text, lang and source count as empty texts; repeated rows count each; a source without kept
terms has count 0 of each; a language of one source has no pairs; an empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from texelframe.llm.common import Words, release, slices, stored

MIN_DOCS = 10
TOP = 10
UNIT = 1_000_000_000
SMOOTH = 2
BLOCK = 4096
CELLS = 2_000_000
TILE = 64
TALLY = 600_000
BATCH = 50_000

NO_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"


class Tally:
    """Occurrences, and documents, of terms in groups, of the slices of a task so far.

    It is emptied when it holds `TALLY` rows, or as many terms or groups.
    """

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.terms: dict[str, int] = {}
        self.key = self.n = self.docs = np.zeros(0, dtype=np.int64)

    def full(self) -> bool:
        return max(len(self.key), len(self.terms), len(self.groups)) >= TALLY

    def add(self, part: pa.RecordBatch) -> None:
        words = Words(pc.ascii_lower(pc.replace_substring_regex(part.column("text"), NO_TERM, " ")))
        n_words = max(1, len(words.distinct))
        in_doc, n = np.unique(words.rows() * n_words + words.codes, return_counts=True)
        names = zip(part.column("lang").to_pylist(), part.column("source").to_pylist())
        group = np.array([self.groups.setdefault(g, len(self.groups)) for g in names], dtype=np.int64)
        term = np.array([self.terms.setdefault(t, len(self.terms)) for t in words.distinct.to_pylist()], dtype=np.int64)
        key = np.concatenate([self.key, (group[in_doc // n_words] << 32) + term[in_doc % n_words] if len(in_doc) else in_doc])
        order = np.argsort(key, kind="stable")
        key = key[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
        add = lambda old, new: np.add.reduceat(np.concatenate([old, new])[order], starts) if len(starts) else old
        self.n, self.docs, self.key = add(self.n, n), add(self.docs, np.ones_like(n)), key[starts]

    def rows(self) -> Iterator[pa.RecordBatch]:
        """What is held, which is then forgotten."""
        lang, source = ([g[k] for g in self.groups] for k in (0, 1))
        terms = pa.array(list(self.terms), pa.string())
        for at in range(0, len(self.key), BATCH):
            some = slice(at, at + BATCH)
            group, term = pa.array(self.key[some] >> 32), pa.array(self.key[some] & 0xFFFFFFFF)
            columns = [pa.array(lang, pa.string()).take(group), pa.array(source, pa.string()).take(group), terms.take(term)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(self.n[some]), pa.array(self.docs[some])], names=["lang", "source", "term", "n", "docs"])
        self.clear()


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, source, term, n, lang_n): occurrences of each term that enough documents of its language hold.

    Tallies go to their term's task, which sums them by source, then over the term's sources: one exchange.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            for part in slices(batch, "text"):
                tally.add(part)
                if tally.full():
                    yield from tally.rows()
        yield from tally.rows()
        del tally
        release()

    found = docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n long, docs long")
    counts = found.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    all_sources = counts.withColumns({"docs": F.sum("docs").over(of_term), "lang_n": F.sum("n").over(of_term)})
    return all_sources.filter(F.col("docs") >= min_docs).drop("docs")


def shares(counts: np.ndarray, total: int, n_terms: int) -> np.ndarray:
    """p of each count; in whole numbers of any size where 64 bits don't hold the product."""
    if int(counts.max(initial=0)) + SMOOTH < (1 << 62) // UNIT:
        return 1 + UNIT * (counts + SMOOTH) // (total + SMOOTH * n_terms)
    return np.array([1 + UNIT * (int(c) + SMOOTH) // (total + SMOOTH * n_terms) for c in counts], dtype=np.int64)


def differences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class Trees:
    """Segment trees of several rows of counts, whose equal subtrees are one node.

    A level's nodes are numbered; `children[k]` holds the two nodes below each node of level k + 1. Leaves are
    the distinct counts; one more stands for the places that fill up the width to a power of two.
    """

    def __init__(self, counts: np.ndarray):
        self.leaves, nodes = np.unique(counts, return_inverse=True)
        nodes = nodes.reshape(counts.shape)
        width = 1 << max(0, counts.shape[1] - 1).bit_length()
        nodes = np.pad(nodes, ((0, 0), (0, width - counts.shape[1])), constant_values=len(self.leaves))
        self.children: list[np.ndarray] = []
        n_below = len(self.leaves) + 1
        while nodes.shape[1] > 1:
            made, nodes_above = np.unique(nodes[:, ::2] * n_below + nodes[:, 1::2], return_inverse=True)
            self.children.append(np.stack([made // n_below, made % n_below]))
            nodes = nodes_above.reshape(len(nodes), -1)
            n_below = len(made)
        self.roots = nodes[:, 0] if counts.shape[1] else np.zeros(len(counts), dtype=np.int64)

    def price(self, a: int, b: int, p: np.ndarray, q: np.ndarray) -> int:
        """The sum of differences of two rows, whose leaves have shares p and q. Each pair of nodes is priced once."""
        x, y = np.array([self.roots[a]]), np.array([self.roots[b]])
        above = []
        for below in reversed(self.children):
            x, y = below[:, x].reshape(-1), below[:, y].reshape(-1)
            n = int(max(x.max(), y.max())) + 1
            pairs, inverse = np.unique(x * n + y, return_inverse=True)
            above.append(inverse)
            x, y = pairs // n, pairs % n
        real = x < len(self.leaves)
        value = np.zeros(len(x), dtype=np.int64)
        value[real] = differences(p[x[real]], q[y[real]])
        for inverse in reversed(above):
            value = value[inverse].reshape(2, -1).sum(axis=0)
        return int(value[0])


def _block(terms: pa.Table, groups: pa.Table) -> pa.Table:
    """Partial sums of pairs, and the best terms, of one block of terms and one tile of sources against all."""
    out: list[tuple] = []
    sources = sorted(groups.column("source").to_pylist(), key=lambda s: s.encode("utf-8", "surrogatepass"))
    total = dict(zip(groups.column("source").to_pylist(), groups.column("total").to_pylist()))
    mine = {s for s, t in zip(groups.column("source").to_pylist(), groups.column("own_tile").to_pylist()) if t}
    n_terms, lang_total = (groups.column(c)[0].as_py() for c in ("n_terms", "lang_total"))
    names = sorted(set(terms.column("term").to_pylist()), key=lambda s: s.encode("utf-8", "surrogatepass"))
    place, row = {t: k for k, t in enumerate(names)}, {s: k for k, s in enumerate(sources)}
    counts = np.zeros((len(sources), len(names)), dtype=np.int64)
    in_lang = np.zeros(len(names), dtype=np.int64)
    at = np.array([place[t] for t in terms.column("term").to_pylist()], dtype=np.int64)
    counts[np.array([row[s] for s in terms.column("source").to_pylist()], dtype=np.int64), at] = terms.column("n").to_numpy()
    in_lang[at] = terms.column("lang_n").to_numpy()
    q = shares(in_lang, lang_total, n_terms) if names else in_lang
    trees = Trees(counts)
    p = [shares(trees.leaves, total[s], n_terms) if names else trees.leaves for s in sources]
    for a, source in enumerate(sources):
        if source not in mine:
            continue
        for b, other in enumerate(sources):
            both = other in mine  # then both ways at once
            if b == a or (both and b < a):
                continue
            value = trees.price(a, b, p[a], p[b]) if names else 0
            out.append((source, "pair", other, value))
            if both:
                out.append((other, "pair", source, value))
        if names:
            used = np.flatnonzero(counts[a])
            own = shares(counts[a][used], total[source], n_terms)
            used, own = used[own > q[used]], own[own > q[used]]
            value = differences(own, q[used])
            for k in np.lexsort((used, -value))[:TOP]:
                out.append((source, "term", names[used[k]], int(value[k])))
    lang = groups.column("lang")[0].as_py()
    columns = [*zip(*out)] if out else [[]] * 4
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
    return pa.table([pa.array([lang] * len(out), pa.string()), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["lang", "source", "part", "item", "value"])


def audit(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, part, item, value, rank): every other source of the language, and the terms most in excess."""
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    used = stored(kept_terms(docs, min_docs))
    langs = used.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n")).groupBy("lang")
    langs = langs.agg(F.count(F.lit(1)).alias("n_terms"), F.sum("lang_n").alias("lang_total"))
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").fillna(0, ["total"])
    per_lang = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources")).join(langs, "lang", "left").fillna(0, ["n_terms", "lang_total"])
    cells = F.greatest(F.col("n_terms") / BLOCK, F.col("n_terms") * F.col("n_sources") / CELLS)
    per_lang = stored(per_lang.withColumns({
        "blocks": F.greatest(F.lit(1), F.ceil(cells)).cast("long"), "tiles": F.ceil(F.col("n_sources") / TILE).cast("long"),
    }))

    def up_to(n: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    by_term = used.join(per_lang.select("lang", "blocks", "tiles"), "lang")
    by_term = by_term.withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks"))).withColumn("tile", up_to("tiles"))
    by_group = groups.join(per_lang, "lang").withColumn("block", up_to("blocks")).withColumn("tile", up_to("tiles"))
    by_group = by_group.withColumn("own_tile", F.pmod(F.xxhash64("source"), F.col("tiles")) == F.col("tile"))
    keys = ["lang", "block", "tile"]
    left = by_term.select(*keys, "source", "term", "n", "lang_n")
    right = by_group.select(*keys, "source", "total", "n_terms", "lang_total", "own_tile")
    parts = stored(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _block, "lang string, source string, part string, item string, value long"
    ))
    pairs = parts.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).unionByName(ranked(parts.filter("part = 'term'")).filter(F.col("rank") <= TOP))
