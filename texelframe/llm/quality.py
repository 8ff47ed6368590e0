"""Document quality by a linear-chain conditional random field over lines.

Every line that isn't blank is labelled good or bad from its own features and those of the lines before
and after it, together with its neighbours' labels. A document's raw quality is the mean
of its lines' forward-backward marginals, weighted by length in bytes; a logistic curve fitted
on the training documents turns it into the probability that the document is good.

The field is fitted on a bounded sample of labelled documents: of `TRAIN_DOCS` of smallest hash, whole
documents in that order, as long as they have no more than `TRAIN_LINES` lines together; a line has its document's label there. All documents are
scored, each over its whole text, which takes about ten times its size in a task.

Defined results: a document without a line (null, empty or blank text) gets the share of good
documents in the sample; without any labelled document all scores are 0.5; repeated rows and
ids are scored each by themselves; other columns are kept by `score`, but for those named
score and predicted, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from texelframe.llm.common import Words, release, slices, stored

TRAIN_DOCS = 4000
TRAIN_LINES = 200_000
STEPS = 120
L2 = 1e-3

# Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = (
    "the of and to in is that for was with as on it by be this are from at or an a "
    "der die das und den von zu mit ist des dem nicht ein eine auf für im sich als auch "
    "le la les de des et un une du en que qui pour dans est pas sur au par avec "
    "el los las y una por con no para su al del se lo como más"
).split()

# Classes of bytes: blank, letter, capital, digit, sentence mark, other mark.
BLANK, LETTER, CAPITAL, DIGIT, MARK, ODD, CLASSES = range(7)


def _byte_classes() -> np.ndarray:
    kind = np.full(256, ODD, dtype=np.int8)
    kind[0x80:] = LETTER
    for c in range(0x21):
        kind[c] = BLANK
    for c in range(128):
        if chr(c).isalpha():
            kind[c] = CAPITAL if chr(c).isupper() else LETTER
        elif chr(c).isdigit():
            kind[c] = DIGIT
        elif chr(c) in ".,;:?!'\"()-":
            kind[c] = MARK
    return kind


KIND = _byte_classes()


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the lines of all texts that aren't blank: features (a row each), lengths in bytes, and for each text the lines up to its end."""
    parts = pc.split_pattern(pc.fill_null(texts, "").cast(pa.large_string()), "\n")
    n_docs = len(parts)
    offsets = parts.offsets.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(n_docs), np.diff(offsets))
    lines = parts.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    keep = pc.match_substring_regex(lines, r"[^\x00-\x20]")
    lines, doc = lines.filter(keep), doc[keep.to_numpy(zero_copy_only=False)]
    ends = np.cumsum(np.bincount(doc, minlength=n_docs)) if n_docs else np.zeros(0, dtype=np.int64)
    n = len(lines)
    if not n:
        return np.zeros((0, N_FEATURES)), np.zeros(0), ends
    edges = np.frombuffer(lines.buffers()[1], dtype=np.int64)[lines.offset : lines.offset + n + 1]
    raw = np.frombuffer(lines.buffers()[2], dtype=np.uint8)[edges[0] : edges[-1]]
    size = np.diff(edges)
    starts, stops = edges[:-1] - edges[0], edges[1:] - edges[0]
    kind = KIND[raw]  # a byte each: nothing wider is made of all bytes
    by_kind = np.column_stack([np.add.reduceat(kind == c, starts, dtype=np.int64) for c in range(CLASSES)]).astype(np.float64)
    line_of = lambda places: np.searchsorted(stops, places, side="right")
    # last bytes of words
    blank_next = np.append(kind[1:] == BLANK, True)
    blank_next[stops - 1] = True
    last = np.flatnonzero((kind != BLANK) & blank_next)
    word_end = np.bincount(line_of(last) * CLASSES + kind[last], minlength=n * CLASSES).reshape(n, CLASSES).astype(np.float64)
    n_words = np.maximum(word_end.sum(axis=1), 1)
    # the same mark twice in a row
    twice = (raw[1:] == raw[:-1]) & (kind[1:] >= MARK)
    twice[stops[:-1] - 1] = False  # not across lines
    doubled = np.bincount(line_of(np.flatnonzero(twice)), minlength=n)
    words = Words(lines)
    rows = words.rows()
    same = np.flatnonzero((words.codes[1:] == words.codes[:-1]) & (rows[1:] == rows[:-1]))
    adjacent = np.bincount(rows[same], minlength=n)
    known = pc.is_in(pc.utf8_lower(words.distinct), pa.array(FUNCTION_WORDS, words.distinct.type)).to_numpy(zero_copy_only=False)
    function = np.bincount(rows, weights=known[words.codes], minlength=n) if len(rows) else np.zeros(n)
    # lines that stand in the document more than once
    code = pc.dictionary_encode(lines).indices.to_numpy(zero_copy_only=False)
    _, inverse, copies = np.unique(doc * (int(code.max()) + 1) + code, return_inverse=True, return_counts=True)
    copies = copies[inverse]
    chars = np.maximum(size - by_kind[:, BLANK], 1)
    letters = np.maximum(by_kind[:, LETTER] + by_kind[:, CAPITAL], 1)
    columns = [
        np.log1p(size) / 8,
        np.log1p(n_words) / 6,
        (by_kind[:, LETTER] + by_kind[:, CAPITAL]) / chars,
        by_kind[:, CAPITAL] / letters,
        by_kind[:, CAPITAL] > 0.5 * letters,
        by_kind[:, DIGIT] / chars,
        by_kind[:, MARK] / chars * 4,
        by_kind[:, ODD] / chars * 4,
        by_kind[:, ODD] > 0.05 * chars,
        doubled / n_words,
        word_end[:, ODD] / n_words,
        word_end[:, MARK] / n_words,
        np.minimum(chars / n_words, 20) / 10,
        adjacent / n_words,
        adjacent > 0.2 * n_words,
        function / n_words,
        (function == 0) & (n_words >= 8),
        KIND[raw[edges[1:] - edges[0] - 1]] == MARK,
        np.minimum(copies - 1, 4) / 4,
    ]
    return np.column_stack([np.asarray(c, dtype=np.float64) for c in columns]), size.astype(np.float64), ends


N_FEATURES = 19


def with_neighbours(x: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Each line's features, those of the lines before and after in its document (zeros at its ends), and a constant."""
    n = len(x)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    first, last = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    full = ends > starts
    first[starts[full]], last[ends[full] - 1] = True, True
    before = np.where(first[:, None], 0.0, np.roll(x, 1, axis=0))
    after = np.where(last[:, None], 0.0, np.roll(x, -1, axis=0))
    return np.hstack([x, before, after, first[:, None], last[:, None], np.ones((n, 1))])


@dataclass
class Steps:
    """Order in which chains of lines advance together: step t holds the t-th line of every chain that long."""

    starts: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, ends: np.ndarray) -> "Steps":
        sizes = np.diff(ends, prepend=0)
        order = np.argsort(-sizes, kind="stable")
        order = order[sizes[order] > 0]
        return cls((ends - sizes)[order], sizes[order])

    def live(self) -> list[int]:
        return np.searchsorted(-self.sizes, -np.arange(int(self.sizes.max(initial=0))), side="left").tolist()


def forward_backward(scores: np.ndarray, transition: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """P(good) of every line, expected counts of label pairs, and the sum of log partition functions.

    scores are log-potentials of good against bad; transition[a, b] those of label b after a.
    """
    steps = Steps.of(ends)
    live, n = steps.live(), len(scores)
    top = np.maximum(scores, 0.0)
    emit = np.exp(np.column_stack([-top, scores - top]))
    move = np.exp(transition)
    alpha, beta, scale = np.empty((n, 2)), np.ones((n, 2)), np.ones(n)
    for t, m in enumerate(live):
        at = steps.starts[:m] + t
        a = emit[at] if t == 0 else (alpha[at - 1] @ move) * emit[at]
        scale[at] = s = a.sum(axis=1)
        alpha[at] = a / s[:, None]
    pairs = np.zeros((2, 2))
    for t in range(len(live) - 1, 0, -1):
        at = steps.starts[: live[t]] + t
        ahead = emit[at] * beta[at] / scale[at][:, None]
        beta[at - 1] = ahead @ move.T
        pairs += move * (alpha[at - 1].T @ ahead)
    return alpha[:, 1] * beta[:, 1], pairs, float(np.log(scale).sum() + top.sum())


@dataclass
class Model:
    weights: np.ndarray
    transition: np.ndarray
    slope: float
    shift: float
    prior: float

    def raw(self, texts: pa.Array) -> np.ndarray:
        x, size, ends = line_features(texts)
        return self.aggregate(x, size, ends)

    def aggregate(self, x: np.ndarray, size: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Length-weighted mean marginal of each document; nan where it has no line."""
        good, _, _ = forward_backward(with_neighbours(x, ends) @ self.weights, self.transition, ends)
        total = lambda v: np.diff(np.concatenate([[0.0], np.cumsum(v)])[ends], prepend=0.0)
        with np.errstate(invalid="ignore"):
            return total(good * size) / total(size)

    def probability(self, raw: np.ndarray) -> np.ndarray:
        p = 1 / (1 + np.exp(-(self.slope * (raw - 0.5) + self.shift)))
        return np.where(np.isnan(raw), self.prior, p)


def train(x: np.ndarray, size: np.ndarray, ends: np.ndarray, label: np.ndarray) -> Model:
    """Fits the field by gradient ascent on the likelihood of the lines' labels, then the logistic curve."""
    if not len(label):
        return Model(np.zeros(3 * N_FEATURES + 3), np.zeros((2, 2)), 0.0, 0.0, 0.5)
    prior = float(label.mean())
    sizes = np.diff(ends, prepend=0)
    y = np.repeat(label, sizes).astype(np.float64)
    f = with_neighbours(x, ends)
    w, move = np.zeros(f.shape[1]), np.zeros((2, 2))
    seen = np.zeros((2, 2))
    np.fill_diagonal(seen, np.bincount(label, weights=np.maximum(sizes - 1, 0), minlength=2)[:2])
    momentum = [np.zeros_like(w), np.zeros_like(w), np.zeros((2, 2)), np.zeros((2, 2))]
    n = max(len(y), 1)
    for k in range(1, STEPS + 1):
        good, pairs, _ = forward_backward(f @ w, move, ends)
        grads = (f.T @ (y - good) / n - L2 * w, (seen - pairs) / n - L2 * move)
        for i, (value, g) in enumerate(zip((w, move), grads)):  # Adam
            m, v = momentum[2 * i], momentum[2 * i + 1]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            value += 0.15 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-9)
    model = Model(w, move, 0.0, 0.0, prior)
    raw = model.aggregate(x, size, ends)
    full = ~np.isnan(raw)
    a = np.column_stack([raw[full] - 0.5, np.ones(int(full.sum()))])
    t = label[full].astype(np.float64)
    c = np.zeros(2)
    for _ in range(25):  # Newton steps; a small penalty keeps a separable sample finite
        p = 1 / (1 + np.exp(-(a @ c)))
        h = (a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(2)
        c += np.clip(np.linalg.solve(h, a.T @ (t - p) - 1e-2 * c), -4, 4)
    model.slope, model.shift = float(c[0]), float(c[1])
    return model


def fit(docs: DataFrame, labels: DataFrame, sample: int = TRAIN_DOCS, lines: int = TRAIN_LINES) -> Model:
    """labels: (doc_id, label 0 or 1), of which at most `sample` are taken, by hash. Features of `lines` lines at most reach the driver.

    Of several rows of one id, the smallest text teaches.
    """
    taken = labels.filter("label in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    taken = taken.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # at most `sample` rows, one of an id
    texts = docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    texts = stored(texts.withColumn("n_lines", F.size(F.split(F.coalesce("text", F.lit("")), "\n"))).withColumn("place", F.xxhash64("doc_id")))
    held, chosen = 0, []
    for r in texts.orderBy("place", "doc_id").select("doc_id", "n_lines").collect():
        if held + r.n_lines <= lines:
            held += r.n_lines
            chosen.append((r.doc_id,))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x, size, ends = line_features(part.column("text"))
                for a, b, label, doc_id in zip([0, *ends[:-1]], ends, part.column("label").to_pylist(), part.column("doc_id").to_pylist()):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v]) for v in (doc_id, label, x[a:b].astype(np.float32).tobytes(), size[a:b].astype(np.float32).tobytes())],
                        names=["doc_id", "label", "x", "size"],
                    )

    chosen = docs.sparkSession.createDataFrame(chosen, "doc_id long")
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text").mapInArrow(features, "doc_id long, label long, x binary, size binary").collect()
    rows.sort(key=lambda r: r.doc_id)
    size = [np.frombuffer(r["size"], np.float32).astype(np.float64) for r in rows]
    x = np.frombuffer(b"".join(r.x for r in rows), np.float32).reshape(-1, N_FEATURES).astype(np.float64)
    ends = np.cumsum([len(s) for s in size], dtype=np.int64)
    return train(x, np.concatenate([*size, np.zeros(0)]), ends, np.array([r.label for r in rows], dtype=np.int64))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score, the probability of being good, and predicted, 1 from 0.5 on."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some hundred numbers
    kept = docs.drop("score", "predicted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                p = model.probability(model.raw(part.column("text")))
                keep = [part.column(c) for c in wanted]
                yield pa.RecordBatch.from_arrays([*keep, pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=[*wanted, "score", "predicted"])
        release()

    wanted = kept.columns
    schema = StructType([*kept.schema.fields]).add("score", "double").add("predicted", "integer")
    return kept.mapInArrow(run, schema)
