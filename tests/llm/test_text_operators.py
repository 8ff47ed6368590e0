"""Tokens, files, packing and mixing against plain versions on small tables."""

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from texelframe.llm import huffman, mixing, packing, token_counts
from texelframe.llm.common import Memo, Words
from texelframe.llm.encoding import Encoder
from texelframe.llm.queries import PIECES, WORD_BPE

ODD = [
    "", None, "  lead and trail \n", "İstanbul ΣΑΣ ǅ J̌ ½ x²³ <|endoftext|>a </w> a</w>b don't 'S'LL 12,5 \x1c \x85\xa0x 😀é <|StartOfText|>",
    "a b", "\t\v\f", "A" * 5000, "word " * 3000, "é" * 700, "a\x00b",
]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string"


def rows_of(texts, sources=("src1", "src0", None)):
    return [(k, t, "en", sources[k % len(sources)], len(t or ""), "clash") for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def words_docs():
    rng = np.random.default_rng(3)
    vocabulary = ["".join(rng.choice(list("abcdeéß.,'"), size=rng.integers(1, 9))) for _ in range(400)]
    return ODD + [" ".join(rng.choice(vocabulary, size=int(rng.choice([1, 5, 80, 900, 6000])))) for _ in range(60)]


@pytest.fixture(scope="module")
def ids_of():
    plain = Tokenizer.from_file(WORD_BPE)
    return lambda text, end: plain.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_words_are_those_of_ascii_white_space():
    texts = ["", None, " a  b\tc\v\n", "x y\xa0z", "  "]
    words = Words(pa.array(texts))
    distinct = words.distinct.to_pylist()
    got = [[distinct[c] for c in words.codes[a:b]] for a, b in zip(words.starts, words.ends)]
    assert got == [[], [], ["a", "b", "c"], ["x", "y\xa0z"], []]


def test_memo_forgets_but_keeps_its_bound():
    memo = Memo(8 * Memo.OVERHEAD)
    for k in range(20):
        memo.keep({str(k): bytes([k])})
        assert memo.find([str(k), "absent"]) == ([bytes([k]), None], [1]) and len(memo.young) + len(memo.old) <= 8
    assert memo.find([str(k) for k in range(20)])[1] == [k for k in range(20) if str(k) not in memo.young | memo.old]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=4))
def test_encoder_gives_the_librarys_ids(texts):
    encoder = _encoder()
    tokens, ends = encoder.encode(pa.array(texts, pa.string()))
    begin = 0
    for text, end in zip(texts, ends):
        assert tokens[begin:end].tolist() == encoder.whole.encode(text, add_special_tokens=False).ids
        begin = end


def _encoder(made=[]):  # noqa: B006
    if not made:
        made.append(Encoder(WORD_BPE))
    return made[0]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 300), st.integers(1, 10**6), min_size=2, max_size=40), st.integers(6, 12))
def test_code_lengths_are_a_full_code_within_the_limit(counts, limit):
    lengths = huffman.code_lengths(counts, limit)
    assert max(lengths.values()) <= limit and sum(2.0**-n for n in lengths.values()) == 1.0
    free = huffman.code_lengths(counts, 40)
    if max(free.values()) <= limit:
        assert sum(counts[s] * n for s, n in lengths.items()) == sum(counts[s] * n for s, n in free.items())


def test_code_lengths_are_the_best_of_all_within_the_limit():
    counts = {0: 1, 1: 1, 2: 2, 3: 9, 4: 30}
    best = min(
        sum(counts[k] * n for k, n in enumerate(t)) for t in itertools.product(range(1, 4), repeat=5) if sum(2.0**-n for n in t) <= 1
    )
    assert sum(counts[s] * n for s, n in huffman.code_lengths(counts, 3).items()) == best


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), max_size=700), max_size=6))
def test_blocks_decode_to_what_was_coded(docs):
    flat = np.array([i for d in docs for i in d], dtype="<u2")
    counts = dict(zip(*(x.tolist() for x in np.unique(flat, return_counts=True)))) or {0: 1}
    codes, bits = huffman.canonical(huffman.code_lengths(counts, 12))
    sizes = np.array([len(d) for d in docs], dtype=np.int64)
    payload, at = huffman.encode_bits(flat, np.cumsum(sizes), codes, bits)
    offsets = [at[b + k] for b, n in zip(np.cumsum(sizes) - sizes, sizes) for k in range(0, n, huffman.CHECKPOINT)]
    out = huffman.Decoder(codes, bits).decode(payload, sizes, np.array(offsets, dtype=np.int64))
    assert out.tolist() == flat.tolist()


def test_ids_come_back_from_files_in_order(spark, words_docs, ids_of):
    docs = spark.createDataFrame(rows_of(words_docs), DOCS).repartition(5)
    blocks, codes = huffman.write_blocks(huffman.token_rows(docs, WORD_BPE, end_id=1))
    whole = {r.doc_id: r for r in huffman.read_blocks(blocks, codes).collect()}
    digest = {r.doc_id: r for r in huffman.read_blocks(blocks, codes, digest=True).collect()}
    start = 0
    for k, text in enumerate(words_docs):
        ids = ids_of(text, 1)
        assert np.frombuffer(whole[k].ids, "<u2").tolist() == ids
        assert (digest[k].start, digest[k].n_tokens, digest[k].ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)


def test_empty_and_repeated_rows_in_files(spark):
    blocks, codes = huffman.write_blocks(huffman.token_rows(spark.createDataFrame([], DOCS), WORD_BPE, end_id=1))
    assert huffman.read_blocks(blocks, codes).count() == 0
    docs = spark.createDataFrame([(7, "a b", "", "", 1, ""), (7, "a b", "", "", 1, ""), (None, "c", "", "", 1, "")], DOCS)
    got = huffman.read_blocks(*huffman.write_blocks(huffman.token_rows(docs, WORD_BPE, end_id=1))).collect()
    assert sorted((r.doc_id or -1, r.start) for r in got) == [(-1, 0), (7, 2), (7, 5)]


def test_packing_holds_every_id_once(spark, words_docs, ids_of):
    docs = spark.createDataFrame(rows_of(words_docs) + rows_of(words_docs)[:3], DOCS).repartition(3)
    pieces = packing.pack(docs, WORD_BPE, end_id=2, window=256).toPandas()
    ids = {k: ids_of(t, 2) for k, t in enumerate(words_docs)}
    for r in pieces.itertuples():
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == crc(ids[r.doc_id][r.start : r.start + r.length])
    covered = pieces.groupby("doc_id").length.sum()
    assert all(covered[k] == len(x) * (2 if k < 3 else 1) for k, x in ids.items())
    for k in range(3, len(ids)):
        own = pieces[pieces.doc_id == k].sort_values("start")
        assert (own.start.to_numpy() == np.cumsum(own.length) - own.length).all()
    for _, sequence in pieces.sort_values("offset").groupby("sequence_id"):
        fill = sequence.length.sum()
        assert (sequence.offset.to_numpy() == np.cumsum(sequence.length) - sequence.length).all()
        assert fill <= 256 and fill & (fill - 1) == 0  # a window or another power of two: no padding
    assert packing.pack(spark.createDataFrame([], DOCS), WORD_BPE, end_id=2).count() == 0


def test_packing_places_whole_documents_by_sum_of_squares():
    packer = packing.Packer(10)
    for k, size in enumerate([6, 4, 6, 4, 5, 5]):
        packer.add(k, size)
    # 6 opens a level, 4 fills it rather than opening another
    assert [[p[0] for p in w] for w in packer.closed] == [[0, 1], [2, 3], [4, 5]]
    bounded = packing.Packer(1000, open_ids=2500)
    for k in range(100):
        bounded.add(k, 501)
        assert bounded.held < 2500
        assert bounded.held == (bounded.counts * np.arange(1001)).sum()
    bounded.level_out()
    assert sum(p[2] for w in bounded.closed for p in w) == 50_100


def test_a_cache_of_words_is_bounded_by_bytes():
    memo = Memo(100_000)
    for k in range(0, 5000, 20):
        memo.keep({f"w{j}": b"x" * (j % 50) for j in range(k, k + 20)} | {"y" * 1000 + str(k): b"long"})
        assert memo.held <= memo.limit
    kept = memo.young | memo.old
    assert sum(memo.OVERHEAD + len(v) for v in kept.values()) <= 101_000 and len(kept) > 100
    assert memo.find(["w4999"])[1] == [] and not any(k.startswith("y") for k in kept)
    memo.keep({f"v{j}": b"x" * 50 for j in range(5000)})  # more than there is room for
    assert sum(memo.OVERHEAD + len(v) for v in memo.young.values()) <= 50_000 and memo.find(["v1"])[1] == []


def plain_tokens(word, trie):
    text = token_counts.WORD_MARK + word
    best = [(0.0, 0)]
    for end in range(1, len(text) + 1):
        size = len(text[end - 1].encode())
        options = [(best[end - 1][0] + size * trie.byte, -(best[end - 1][1] + size))]
        for begin in range(end):
            if (s := trie.scores.get(text[begin:end])) is not None:
                options.append((s + best[begin][0], -(best[begin][1] + 1)))
        top = max(options)
        best.append((top[0], -top[1]))
    return best[-1][1]


def test_trie_counts_are_those_of_each_word_alone(spark, words_docs):
    scores = token_counts.load_scores(PIECES)
    trie, small = token_counts.Trie(scores), token_counts.Trie(scores, max_nodes=50)
    words = sorted({w for t in words_docs for w in (t or "").encode().split()})
    for w in [w.decode() for w in words if len(w) < 60]:
        assert trie.count(w) == small.count(w) == plain_tokens(w, trie)
    for w in [w.decode() for w in words][:200] + ["", "a" * 300, "这是" * 200, "the" * 100 + "é"]:
        assert trie.count_long(w) == trie.insert(w)
    long = token_counts.Trie(scores, max_nodes=1000)
    assert long.count("abc" * 100_000) > 0 and len(long.best) <= 1000  # not in the trie
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in token_counts.count_tokens(spark.createDataFrame(rows_of(words_docs), DOCS), PIECES).collect()}
    for k, t in enumerate(words_docs):
        own = [w.decode() for w in (t or "").encode().split()]
        assert got[k] == (len(own), sum(trie.count(w) for w in own))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=12))
def test_targets_share_all_words_within_the_limit(sizes):
    weights = [(5.0, 2.0, 1.0)[k % 3] for k in range(len(sizes))]
    wanted = mixing.targets(sizes, weights)
    assert all(t <= 3 * s + 1e-6 for t, s in zip(wanted, sizes)) and sum(wanted) == pytest.approx(sum(sizes))
    free = [t / w for t, w, s in zip(wanted, weights, sizes) if s and t < 3 * s - 1e-6]
    assert not free or max(free) == pytest.approx(min(free))


def test_pairs_keep_the_expected_words():
    rng = np.random.default_rng(1)
    size, p, u = rng.integers(1, 90, 50).astype(float), rng.random(50), rng.random(50)
    out, residual = mixing._round_group(size, p, u)
    assert (size * out).sum() == pytest.approx((size * p).sum())
    assert all(x in (0.0, 1.0) for k, x in enumerate(out) if k != residual)


def test_mix_comes_near_its_targets_and_repeats(spark, monkeypatch):
    rng = np.random.default_rng(5)
    texts = [" ".join(["w"] * int(rng.integers(0, 60))) for _ in range(600)]
    rows = rows_of(texts, ("b", "a", None, "b", "b")) + rows_of(texts, ("b", "a", None, "b", "b"))[:9] + [(None, None, None, None, None, None)] * 2
    docs = spark.createDataFrame(rows, DOCS)
    monkeypatch.setattr(mixing, "GROUP", 16)  # several levels of the tree
    mixed = mixing.mix(docs).toPandas()
    assert len(mixed) == len(rows) and list(mixed.columns) == [*docs.columns, "size", "source_size", "target", "copies"]
    assert (mixed.copies >= 0).all() and (mixed.copies <= 3).all()
    assert (mixed["size"] == mixed.text.map(lambda t: len((t or "").split()))).all()
    for source, own in mixed.groupby(mixed.source.fillna("~")):
        assert abs((own["size"] * own.copies).sum() - own.target.iloc[0]) <= 5
        assert own.source_size.iloc[0] == own["size"].sum()
    again = mixing.mix(docs.repartition(7)).toPandas()
    key = ["doc_id", "source", "text"]
    count = lambda m: m.fillna({"doc_id": -1, "source": "~", "text": ""}).groupby(key).copies.sum().to_dict()
    assert count(mixed) == count(again)
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0


def test_every_size_is_taken_as_often_as_its_source_wants(spark, monkeypatch):
    """Over many documents, in groups of a few and so over many levels, none is favoured for its size or place."""
    monkeypatch.setattr(mixing, "GROUP", 3)
    sizes = (1, 7, 60)
    texts = [" ".join(["w"] * sizes[k % 3]) for k in range(6000)]
    mixed = mixing.mix(spark.createDataFrame(rows_of(texts, ("a", "b")), DOCS)).toPandas()
    for (source, size), own in mixed.groupby([mixed.source, mixed["size"]]):
        ratio = own.target.iloc[0] / own.source_size.iloc[0]
        p = ratio - int(ratio)
        assert 0.1 < p < 0.9
        assert abs(own.copies.mean() - ratio) < 4 * (p * (1 - p) / len(own)) ** 0.5, (source, size)
        halves = own.copies[own.doc_id < 3000].mean(), own.copies[own.doc_id >= 3000].mean()
        assert abs(halves[0] - halves[1]) < 6 * (p * (1 - p) / (len(own) / 2)) ** 0.5


def test_fresh_numbers_keep_probabilities_over_levels():
    """A document's number of a level says nothing of the next one: twelve documents in groups of three, many times."""
    rng = np.random.default_rng(3)
    size, taken = rng.integers(1, 9, 12).astype(float), np.zeros(12)
    for _ in range(4000):
        p, live = np.full(12, 0.37), np.arange(12)
        for step in (3, 3, 12):
            rest = []
            for at in range(0, len(live), step):
                group = live[at : at + step]
                p[group], left = mixing._round_group(size[group], p[group], rng.random(len(group)))
                if left >= 0:
                    rest.append(group[left])
            live = np.array(rest, dtype=np.int64)
        for k in live:
            p[k] = float(rng.random() < p[k])
        taken += p
    assert abs(taken / 4000 - 0.37).max() < 0.035


def test_large_groups_of_equal_rows_are_rounded_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "TWINS", 50)
    rows = rows_of(["a b c"], ("a",)) * 730 + rows_of([" ".join(["w"] * (k % 9)) for k in range(400)], ("b",))[1:]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    mixed = mixing.mix(docs).toPandas()
    same = mixed[mixed.source == "a"]
    ratio = same.target.iloc[0] / same.source_size.iloc[0]
    assert len(mixed) == len(rows) and len(same) == 730
    assert set(same.copies) <= {int(ratio), int(ratio) + 1} and abs(same.copies.sum() - 730 * ratio) < 1
    assert mixing.mix(docs.repartition(3)).filter("source = 'a'").agg(F.sum("copies")).first()[0] == same.copies.sum()
