"""Toxicity by weak supervision.

Many voters look at a document: words of fixed lexicons, words and word beginnings that
training documents use when they are toxic, and patterns. A generative label model
explains their votes: the true label, each voter's accuracy given it, and correlations between
voters along a tree (each voter may depend on one other). Its parameters are fitted
by expectation maximisation on a bounded sample of labelled documents, in which the given label is a
voter like others, only taken to be mostly right at first. A linear classifier of the votes and their counts is then trained on the
model's posterior labels, and scores all documents, each over its whole text.

The sample holds at most `TRAIN_DOCS` documents, those of smallest hash.

Defined results: a text without words (null, empty, blank) gets the score of a document without
any vote; without labelled documents the fixed lexicons alone decide (score 0.9 from one
hit on, else 0.05); repeated rows are scored each by themselves; other columns are kept, but for
those named score and predicted, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from texelframe.llm.common import Words, release, slices

TRAIN_DOCS = 8000
MIN_TOXIC = 4  # documents of the sample that a mined word is in
MIN_SHARE = 0.75  # of these, toxic ones
STEMS = (3, 4, 5, 6)  # lengths of word beginnings
MINED_VOTERS = 4  # voters that the mined words, and the stems of each length, are dealt to
THRESHOLD = 0.3

# Words of insult, contempt, abuse and threat in English, German, French, Spanish.
LEXICONS = {
    "insult": "idiot idiots moron morons imbecile fool dumbass dummy loser losers clown clowns cretin halfwit "
    "dummkopf trottel depp vollidiot crétin imbécile abruti débile tonto estúpido imbécil bobo".split(),
    "contempt": "stupid worthless pathetic disgusting trash garbage scum filth vermin ugly "
    "dumm wertlos widerlich abschaum dreck stupide dégoûtant ordure minable asqueroso basura inútil patético".split(),
    "abuse": "bastard bitch asshole jerk whore slut fuck fucking shit bullshit damn crap "
    "arschloch scheisse scheiße hure wichser connard salope merde putain cabrón puta mierda gilipollas".split(),
    "threat": "kill die hurt destroy murder umbringen töten crever tuer matar muérete".split(),
}
PATTERNS = ("any", "several", "dense", "second_person", "shouting", "exclaiming")
YOU = {"you", "your", "youre", "du", "dich", "dein", "tu", "toi", "ton", "tú", "eres"}
ABUSIVE = ("insult", "contempt", "abuse")


@dataclass
class Votes:
    """The voters' words; `of` maps a word in lower case to the voters that know it."""

    words: dict[str, int] = field(default_factory=dict)  # mined word -> voter
    stems: dict[str, int] = field(default_factory=dict)  # mined beginning -> voter

    @property
    def names(self) -> list[str]:
        mined = [f"{kind}_{k}" for kind in ("word", *(f"stem{n}" for n in STEMS)) for k in range(MINED_VOTERS)]
        return [*LEXICONS, *mined, *PATTERNS]

    def table(self) -> dict[str, tuple[int, ...]]:
        known: dict[str, list[int]] = {}
        for k, words in enumerate(LEXICONS.values()):
            for w in words:
                known.setdefault(w, []).append(k)
        for w, k in self.words.items():
            known.setdefault(w, []).append(k)
        return {w: tuple(v) for w, v in known.items()}

    def count(self, texts: pa.Array) -> np.ndarray:
        """Hits of each voter in each text; of the patterns 0 or 1. One more column: words."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        letters = pc.utf8_lower(pc.replace_substring_regex(texts, r"[^\p{L}]+", " "))
        words = Words(letters)
        table, stems, names = self.table(), self.stems, self.names
        n, m = len(texts), len(names)
        hits = []
        you = np.zeros(len(words.distinct), dtype=bool)
        for k, w in enumerate(words.distinct.to_pylist()):
            for v in table.get(w, ()):
                hits.append((k, v))
            if stems:
                for length in STEMS:
                    v = stems.get(w[:length]) if len(w) >= length else None
                    if v is not None:
                        hits.append((k, v))
            you[k] = w in YOU
        counts = np.zeros((n, m + 1))
        rows = words.rows()
        for v in {v for _, v in hits}:
            mask = np.zeros(len(you), dtype=bool)
            mask[[k for k, x in hits if x == v]] = True
            counts[:, v] = np.bincount(rows[mask[words.codes]], minlength=n)
        counts[:, m] = words.counts
        strong = [k for k, name in enumerate(names[: -len(PATTERNS)]) if name != "threat"]
        total = counts[:, strong].sum(axis=1)
        at = {name: m - len(PATTERNS) + k for k, name in enumerate(PATTERNS)}
        counts[:, at["any"]] = total >= 1
        counts[:, at["several"]] = total >= 3
        counts[:, at["dense"]] = total > 0.01 * np.maximum(words.counts, 1)
        abusive = counts[:, [k for k, name in enumerate(LEXICONS) if name in ABUSIVE]].sum(axis=1)
        addressed = np.bincount(rows[you[words.codes]], minlength=n)
        counts[:, at["second_person"]] = (abusive > 0) & (addressed > 0)
        size = np.maximum(pc.utf8_length(texts).to_numpy(zero_copy_only=False), 1)
        counts[:, at["shouting"]] = pc.match_substring_regex(texts, r"[A-Z]{4,} [A-Z]{2,} [A-Z]{2,}").to_numpy(zero_copy_only=False)
        counts[:, at["exclaiming"]] = pc.count_substring(texts, "!!").to_numpy(zero_copy_only=False) > 0.005 * size
        return counts


@dataclass
class LabelModel:
    """P(label) and, along a tree, P(vote of a voter | vote of its parent, label)."""

    prior: float
    parent: np.ndarray
    tables: np.ndarray  # [voter, label, parent's vote, vote]

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        log = np.log(np.array([1 - self.prior, self.prior]))[None, :].repeat(len(votes), axis=0)
        for j, p in enumerate(self.parent):
            above = votes[:, p] if p >= 0 else np.zeros(len(votes), dtype=np.int64)
            log += np.log(self.tables[j][:, above, votes[:, j]]).T
        log -= log.max(axis=1, keepdims=True)
        like = np.exp(log)
        return like[:, 1] / like.sum(axis=1)


def dependence_tree(votes: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The tree of largest mutual information between voters given the label: each voter's parent, -1 at the root."""
    m = votes.shape[1]
    info = np.zeros((m, m))
    for weight in (q, 1 - q):
        total = weight.sum() + 1e-9
        one = votes.T @ weight / total
        both = (votes * weight[:, None]).T @ votes / total
        for a in (0, 1):
            for b in (0, 1):
                pa_ = one if a else 1 - one
                pb = one if b else 1 - one
                joint = both if a and b else (pa_[:, None] - both if a else (pb[None, :] - both if b else 1 - one[:, None] - one[None, :] + both))
                joint = np.maximum(joint, 1e-9)
                info += total / len(q) * joint * np.log(joint / np.maximum(np.outer(pa_, pb), 1e-9))
    parent, inside = np.full(m, -1), np.zeros(m, dtype=bool)
    best, link = np.full(m, -np.inf), np.full(m, -1)
    at = 0
    for _ in range(m):  # Prim
        inside[at] = True
        parent[at] = link[at]
        better = ~inside & (info[at] > best)
        best[better], link[better] = info[at][better], at
        if inside.all():
            break
        at = int(np.argmax(np.where(inside, -np.inf, best)))
    return parent


def fit_label_model(votes: np.ndarray, label: np.ndarray, rounds: int = 12, trust: float = 0.95) -> tuple[LabelModel, np.ndarray]:
    """votes: 0 or 1 of each document and voter; label: the given one, which votes last. Returns the model and the posterior labels."""
    votes = np.column_stack([votes, label]).astype(np.int64)
    q = np.where(label == 1, trust, 1 - trust).astype(np.float64)
    model = None
    for k in range(rounds):
        if k % 4 == 0:
            parent = dependence_tree(votes, q)
            parent[parent == votes.shape[1] - 1] = -1  # the given label depends on no voter, nor they on it
            parent[-1] = -1
        tables = np.empty((votes.shape[1], 2, 2, 2))
        for j, p in enumerate(parent):
            above = votes[:, p] if p >= 0 else np.zeros(len(votes), dtype=np.int64)
            for y, weight in ((0, 1 - q), (1, q)):
                seen = np.bincount(above * 2 + votes[:, j], weights=weight, minlength=4).reshape(2, 2) + 0.5
                tables[j, y] = seen / seen.sum(axis=1, keepdims=True)
        # a label that is given is right more often than not, but not beyond `trust`: else it comes to be the truth by itself
        for y in (0, 1):
            right = float(np.clip(tables[-1, y, 0, y], min(0.9, trust), trust))
            tables[-1, y, :, y], tables[-1, y, :, 1 - y] = right, 1 - right
        model = LabelModel(float(np.clip(q.mean(), 1e-4, 1 - 1e-4)), parent, tables)
        q = model.posterior(votes)
    return model, q


def inputs(counts: np.ndarray) -> np.ndarray:
    """Of the classifier: each voter's vote and its count, the share of words that any voter knows, and a constant."""
    hits, words = counts[:, :-1], np.maximum(counts[:, -1], 1)
    total = hits[:, : -len(PATTERNS)].sum(axis=1)
    return np.column_stack([hits > 0, np.log1p(hits), np.log1p(total), np.minimum(total / words * 20, 2), np.ones(len(hits))]).astype(np.float64)


def train_linear(x: np.ndarray, q: np.ndarray, l2: float = 1.0) -> np.ndarray:
    """Logistic regression on soft labels, by Newton's method."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], l2)
    penalty[-1] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(h, x.T @ (q - p) - penalty * w)
        w += step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Model:
    votes: Votes
    weights: np.ndarray | None
    label_model: LabelModel | None = None

    def probability(self, texts: pa.Array) -> np.ndarray:
        counts = self.votes.count(texts)
        if self.weights is None:
            return np.where(counts[:, : len(LEXICONS) - 1].sum(axis=1) > 0, 0.9, 0.05)
        return 1 / (1 + np.exp(-np.clip(inputs(counts) @ self.weights, -30, 30)))


def _sample(labels: DataFrame, sample: int) -> DataFrame:
    taken = labels.filter("label in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    return taken.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def mine(texts: DataFrame) -> Votes:
    """Words and word beginnings of the sampled (label, text) that toxic documents use and others hardly do."""
    words = F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+"))
    each = texts.select("label", "doc_id", F.explode(words).alias("word")).filter("word <> ''")

    def found(unit: Column, kind: str) -> DataFrame:
        own = each.select("label", "doc_id", unit.alias("unit")).filter("unit is not null").distinct()
        out = own.groupBy("unit").agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n"))
        return out.filter((F.col("toxic") >= MIN_TOXIC) & (F.col("toxic") >= MIN_SHARE * F.col("n"))).select(F.lit(kind).alias("kind"), "unit", "toxic", "n")

    all_ = found(F.col("word"), "word")
    for n in STEMS:
        all_ = all_.union(found(F.when(F.length("word") >= n, F.substring("word", 1, n)), f"stem{n}"))
    votes = Votes()
    names = votes.names
    # the sample's size bounds what comes here
    for k, r in enumerate(sorted(all_.collect(), key=lambda r: (r.kind, r.unit))):
        voter = names.index(f"{r.kind}_{k % MINED_VOTERS}")
        (votes.words if r.kind == "word" else votes.stems)[r.unit] = voter
    return votes


def fit(docs: DataFrame, labels: DataFrame, sample: int = TRAIN_DOCS) -> Model:
    """labels: (doc_id, label 0 or 1), of which at most `sample` are taken, by hash. Of several rows of one id, the smallest text teaches."""
    texts = docs.select("doc_id", "text").join(F.broadcast(_sample(labels, sample)), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))  # at most `sample` rows
    texts = texts.repartition(8).cache()
    votes = mine(texts)
    width = len(votes.names) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                counts = votes.count(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label").cast(pa.int64()), pa.array([c.tobytes() for c in counts], pa.binary())], names=["doc_id", "label", "counts"]
                )

    rows = texts.select("doc_id", "label", "text").mapInArrow(count, "doc_id long, label long, counts binary").collect()
    texts.unpersist()
    if not rows:
        return Model(votes, None)
    rows.sort(key=lambda r: (r.doc_id, bytes(r["counts"])))
    counts = np.frombuffer(b"".join(r["counts"] for r in rows)).reshape(-1, width)
    label_model, q = fit_label_model((counts[:, :-1] > 0).astype(np.int64), np.array([r.label for r in rows]))
    return Model(votes, train_linear(inputs(counts), q), label_model)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """docs with score, the probability of being toxic, and predicted, 1 from the threshold on."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    kept = docs.drop("score", "predicted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                p = model.probability(part.column("text"))
                keep = [part.column(c) for c in wanted]
                yield pa.RecordBatch.from_arrays([*keep, pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=[*wanted, "score", "predicted"])
        release()

    wanted = kept.columns
    schema = StructType([*kept.schema.fields]).add("score", "double").add("predicted", "integer")
    return kept.mapInArrow(run, schema)
