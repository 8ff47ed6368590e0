"""Components, joins, vectors and urls against brute force on small tables."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from texelframe.llm import lattice, lattice_dedup, ngram_join, url_filter, vector_tree
from texelframe.llm.components import connected_components
from texelframe.llm.queries import RULES

DOCS = "doc_id long, text string, component_id long"
VECTORS = "vec_id long, embedding array<double>, label int, rep long"


def joined(edges, nodes):
    part = {n: n for n in nodes}
    for _ in nodes:
        for a, b in edges:
            part[a] = part[b] = min(part[a], part[b])
    return part


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(k, k + 1) for k in range(30)], [(0, k) for k in range(9, 40)] + [(50, 39), (60, 61)]])
def test_components(spark, edges):
    nodes = {n for e in edges for n in e}
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: c for n, c in joined(edges, nodes).items() if n != c}


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def near_texts():
    rng = np.random.default_rng(2)
    vocabulary = [f"w{k}" for k in range(300)]
    passage = " ".join(rng.choice(vocabulary, 60))
    texts = ["", None, "  \n", "one", "ONE", "one two three four five", "one two three four five six"]
    for n in (8, 30, 120, 700):
        base = rng.choice(vocabulary, n).tolist()
        for changes in (0, 0, 1, 1, 2, 3, 5, n // 20, n // 15, n // 10):
            copy = list(base)
            for at in rng.choice(n, min(changes, n), replace=False):
                copy[at] = "x" + str(rng.integers(1000))
            texts.append(" ".join(copy))
        texts += [passage + " " + " ".join(rng.choice(vocabulary, 40)) for _ in range(5)]
    # a chain: neighbours link, its ends don't
    base = [f"c{k}" for k in range(104)]
    texts += [" ".join(base[k : k + 90]) for k in range(0, 14, 2)]
    return texts


def brute_components(rows, percent):
    """(doc_id, shingles, component) of each row: rows of an id share their links."""
    sets = [shingles(t) for _, t, *_ in rows]
    alive = [k for k, r in enumerate(rows) if r[0] is not None and sets[k]]
    edges = [
        (rows[a][0], rows[b][0]) for a in alive for b in alive if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    part = joined(edges, {r[0] for r in rows if r[0] is not None})
    return edges, sorted((r[0] is None, r[0] or 0, len(s), part.get(r[0], 0)) for r, s in zip(rows, sets))


def got_components(spark, rows, **options):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, component_id long, key int, digest string")
    got = ngram_join.near_duplicates(df, **options).collect()
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got)


@pytest.mark.parametrize("percent", [50, 60, 80, 100])
def test_near_duplicates_are_those_of_all_pairs(spark, monkeypatch, percent):
    rows = [(3 * k + 1, t, 0) for k, t in enumerate(near_texts())] + [(None, "one two three four five", 0)]
    monkeypatch.setattr(ngram_join, "TILE", 3)  # several slots a tile
    edges, want = brute_components(rows, percent)
    assert len(edges) > 10 and got_components(spark, rows, percent=percent) == want


def test_rows_of_one_id_share_their_links(spark):
    rng = np.random.default_rng(9)
    a, b, c = ([f"{x}{k}" for k in rng.integers(0, 9999, 100)] for x in "abc")
    near = lambda words, k: " ".join([*words[:50], f"other{k}", *words[51:]])
    rows = [(5, " ".join(a), 0), (5, " ".join(b), 0), (9, near(a, 1), 0), (11, near(b, 2), 0)]
    rows += [(20, " ".join(c), 0), (21, " ".join(c), 0), (21, "lone words of its own here", 0), (30, "lone words of its own here", 0)]
    rows += [(40, "same row as ever it was", 0)] * 3 + [(41, "", 0), (41, "same row as ever it was", 0), (42, None, 0)]
    _, want = brute_components(rows, 80)
    got = got_components(spark, rows)
    assert got == want and {k: p for _, k, _, p in got} == {5: 5, 9: 5, 11: 5, 20: 20, 21: 20, 30: 20, 40: 40, 41: 40, 42: 42}
    assert got_components(spark, []) == [] and got_components(spark, [(1, None, 0), (2, " ", 0)]) == [(False, 1, 0, 1), (False, 2, 0, 2)]


def family_texts():
    """Copies of a text, each with a number of words changed: some link, most are only alike."""
    rng = np.random.default_rng(6)
    base = [f"f{k}" for k in range(150)]
    texts = []
    for changes in (0, 1, 1, 2, 2, *[4] * 20, *[6] * 10):
        copy = list(base)
        for at in rng.choice(len(base), changes, replace=False):
            copy[at] = "x" + str(rng.integers(100000))
        texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("tile, pairs, shingles, rows", [(3, 7, 400, 2), (8, 1, 1, 5), (4096, 1 << 14, 1 << 20, 10000)])
def test_a_family_of_unlinked_documents(spark, monkeypatch, tile, pairs, shingles, rows):
    for name, value in (("TILE", tile), ("PAIRS", pairs), ("SHINGLES", shingles)):
        monkeypatch.setattr(ngram_join, name, value)
    texts = [(2 * k + 1, t, 0) for k, t in enumerate(family_texts())]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)  # cells go on over several batches
    try:
        edges, want = brute_components(texts, 80)
        assert 10 < len(edges) < len(texts) ** 2 / 4 and got_components(spark, texts) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_a_set_is_sent_to_a_block_once(spark, monkeypatch):
    sets, ends = ngram_join.shingle_sets(pa.array(family_texts()))
    starts = [0, *ends[:-1].tolist()]
    each = [sets[a:b] for a, b in zip(starts, ends.tolist())]
    n = len(each)
    stored = spark.createDataFrame([(k, -k, bytearray(x.tobytes())) for k, x in enumerate(each)], "doc long, half long, shingles binary")
    pairs = [(a, -a, len(each[a]), b, -b, len(each[b]), 5) for a in range(n) for b in range(a + 1, n)]
    pairs = spark.createDataFrame(pairs, "a_doc long, a_half long, a_n long, b_doc long, b_half long, b_n long, family long")
    both = {(a, b): len(np.intersect1d(each[a], each[b])) for a in range(n) for b in range(a + 1, n)}
    want = {(a, b) for (a, b), m in both.items() if 100 * m >= 80 * (len(each[a]) + len(each[b]) - m)}
    assert 10 < len(want) < len(both) / 2
    # one block, and blocks of a pair of slots each
    for shingles, sent in ((1 << 20, n), (sum(map(len, each)) // 4 + 1, 7 * n)):
        monkeypatch.setattr(ngram_join, "SHINGLES", shingles)
        rows = ngram_join.blocks(pairs, stored)
        assert rows.filter("shingles is not null").count() <= sent and rows.filter("shingles is null").count() == len(both)
        assert {(r.a_doc, r.b_doc) for r in ngram_join.verified_in_blocks(pairs, stored, 80).collect()} == want


def test_layouts_miss_next_to_nothing():
    for percent in range(50, 101):
        keys, orders = ngram_join.layout(percent)
        assert keys <= ngram_join.MOST_KEYS and (percent == 100 or (1 - (percent / 100) ** orders) ** keys <= ngram_join.MISSED)
    with pytest.raises(ValueError):
        ngram_join.layout(49)


def test_partners_are_at_most_a_band_apart(spark):
    for percent in (50, 80, 95):
        sizes = [*range(1, 400), 1000, 4096, 10**6, 10**9]
        pairs = spark.createDataFrame([(n, m) for n in sizes for m in {n, n * 100 // percent, max(n, n * 100 // percent - 1)}], "n long, m long")
        off = ngram_join.size_band(F.col("m"), percent) - ngram_join.size_band(F.col("n"), percent)
        assert {r[0] for r in pairs.select(off).distinct().collect()} <= {0, 1}


def test_bitmaps_never_rule_out_a_link():
    rng = np.random.default_rng(4)
    for n in (1, 5, 80, 600, 5000):
        base = rng.integers(0, 2**63, n).astype(np.uint64)
        other = np.unique(np.concatenate([base[: n - n // 9], rng.integers(0, 2**63, n // 9).astype(np.uint64)]))
        base = np.unique(base)
        bits = ngram_join.bitmaps(np.concatenate([base, other]), np.cumsum([len(base), len(other)]))
        only = sum(int(x & ~y & (2**64 - 1)).bit_count() for x, y in zip(bits[0].tolist(), bits[1].tolist()))
        if ngram_join.fold(np.array([len(base)])) == ngram_join.fold(np.array([len(other)])):
            assert len(np.intersect1d(base, other)) <= len(base) - only


@settings(max_examples=50, deadline=None)
@given(st.lists(st.floats(-3, 3), min_size=8, max_size=8))
def test_e8_decodes_to_the_nearest_point(x):
    x = np.array([x])
    near = lattice.nearest_e8(x)[0]
    assert (near * 2 == np.rint(near * 2)).all() and len({v % 1 for v in near}) == 1 and near.sum() % 2 == 0
    around = near + np.vstack([lattice.roots(), 2 * np.eye(8), -2 * np.eye(8)])
    assert ((x[0] - near) ** 2).sum() <= ((x[0] - around) ** 2).sum(axis=1).min() + 1e-9


ODD_VECTORS = [None, [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0], [1e-200] * 16, [1e200] * 16]


def vector_rows(seed=6):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(60):
        base = rng.normal(size=16)
        rows += [(base + rng.normal(size=16) * scale).tolist() for scale in (0.0, 0.0, 0.02, 0.1, 0.3)]
        rows.append((base * 7).tolist())
    return [(k, v, 0, 0) for k, v in enumerate([*ODD_VECTORS, *rows])]


def test_near_vectors_are_those_of_all_pairs(spark):
    rows = vector_rows()
    got = {r.vec_id: r for r in lattice_dedup.near_duplicates(spark.createDataFrame([*rows, rows[12], (None, [1.0] * 16, 0, 0)], VECTORS)).collect()}
    good = {k: np.array(v) for k, v, *_ in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    unit = {k: v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for k, v in good.items()}
    edges = [(a, b) for a in good for b in good if a < b and len(good[a]) == len(good[b]) and unit[a] @ unit[b] >= 0.9]
    found = sum(got[k].n_links for k, *_ in rows) / 2
    assert 0.98 * len(edges) <= found <= len(edges)
    part = joined(edges, [k for k, *_ in rows])
    assert np.mean([got[k].component_id == part[k] for k, *_ in rows]) > 0.99
    assert all(got[k].kept == (got[k].component_id == k) for k, *_ in rows) and got[None].n_links == 0
    assert got[5].n_links == 1 and got[7].n_links == 1  # other lengths and magnitudes
    assert lattice_dedup.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def true_nearest(rows, length, step, n):
    good = [(k, np.array(v)) for k, v, *_ in rows if v and len(v) == length and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in good:
        if q % step == 0:
            out[q] = sorted(((-(x * v).sum(), k) for k, v in good if k != q))[:n]
    return out


@pytest.mark.parametrize("slot", [4096, 32])
def test_tree_search_against_all_vectors(spark, monkeypatch, slot):
    monkeypatch.setattr(vector_tree, "SLOT", slot)
    rows = [r for r in vector_rows() if r[0] not in (7, 8)]
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    got = vector_tree.nearest(frame, F.col("vec_id") % 10 == 0, n=20, leaf=16).toPandas()
    want = true_nearest(rows, 16, 10, 20)
    hits = sum(len({k for _, k in near} & set(got[got.query_id == q].vec_id)) for q, near in want.items())
    assert hits >= 0.9 * sum(map(len, want.values())) and set(got.query_id) == set(want)
    one_leaf = vector_tree.nearest(frame, F.col("vec_id") % 10 == 0, n=20, leaf=10**6).toPandas()
    for q, near in want.items():
        own = one_leaf[one_leaf.query_id == q].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, len(near) + 1))
        assert own.vec_id.tolist() == [k for _, k in near] and own.score.to_numpy() == pytest.approx([-s for s, _ in near])


def test_queries_outside_dense_groups_get_all_their_rows(spark):
    """Nearly all neighbours are in leaves full of near copies; the leaves of other vectors hold a few each."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(3, 12))
    rows = [(k, (centres[k % 3] + rng.normal(size=12) * 1e-3).tolist(), 0, 0) for k in range(3000)]
    rows += [(3000 + k, (rng.normal(size=12) * 3).tolist(), 0, 0) for k in range(100)]
    frame = spark.createDataFrame(rows, VECTORS)
    got = vector_tree.nearest(frame, F.col("vec_id") % 20 == 0, n=20, leaf=4).toPandas()
    assert got.groupby("query_id").size().to_dict() == {k: 20 for k in range(0, 3100, 20)}
    few = vector_tree.nearest(frame.filter("vec_id >= 3080"), F.col("vec_id") == 3080, n=20, leaf=2).toPandas()
    assert len(few) == 19  # all candidates there are


def test_tree_search_of_few_equal_or_no_vectors(spark):
    same = spark.createDataFrame([(k, [1.0, 1.0], 0, 0) for k in range(0, 140, 2)], VECTORS)
    got = vector_tree.nearest(same, F.col("vec_id") == 100, n=3, leaf=4).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(got)] == [(1, 0, 2.0), (2, 2, 2.0), (3, 4, 2.0)]
    assert vector_tree.nearest(same.filter("vec_id = 0"), F.lit(True), n=3).count() == 0
    assert vector_tree.nearest(same.filter("vec_id < 0"), F.lit(True), n=3).count() == 0


def page(to=None, refresh=None):
    return (f'<LINK href="{to}" rel="canonical">' if to else "") + (f"<meta http-equiv='refresh' content='0; url={refresh}'>" if refresh else "<p>")


def test_urls_by_rules_and_aliases(spark):
    rows = [
        (1, "http://A.Example.ORG/es/1?x#y", None),
        (2, "http://example.org/en/12", page()),
        (3, "http://example.org/en/2", page()),
        (4, "http://notorg/", page()),
        (5, "http://x.com/fr/", page(to="http://x.com/de/9")),  # allowed by a rule, though its alias is blocked
        (6, "https://alias.net/a?q=1", page(to="/b")),
        (7, "https://alias.net/b", page(refresh="//other.net/c&amp;d")),
        (8, "http://other.net/c&d#f", page(to="http://bad.com/de/1")),
        (9, "https://alias.net/e", page(refresh="b")),
        (10, "https://alias.net/free", page(to="https://alias.net/free?utm=1")),
        (11, None, page(to="http://bad.com/de/1")),
        (12, "no scheme", page(to="http://bad.com/de/1")),
        (13, "http://org", None),
        (13, "http://org", None),
        (14, "http://bad.com/de/5", "x" * 100_000),
    ]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, RULES).collect()}
    assert got == {
        1: ("a.example.org", "/es/1", "example.org/es/", "block"),
        2: ("example.org", "/en/12", "example.org/en/1", "block"),
        3: ("example.org", "/en/2", "org/", "allow"),
        4: ("notorg", "/", None, "allow"),
        5: ("x.com", "/fr/", "com/fr/", "allow"),
        6: ("alias.net", "/a", None, "block"),
        7: ("alias.net", "/b", None, "block"),
        8: ("other.net", "/c&d", None, "block"),
        9: ("alias.net", "/e", None, "block"),
        10: ("alias.net", "/free", None, "allow"),
        11: ("", "", None, "allow"),
        12: ("", "", None, "allow"),
        13: ("org", "", None, "allow"),
        14: ("bad.com", "/de/5", "com/de/", "block"),
    }
    assert url_filter.judge(pages, RULES).count() == len(rows)
    more = spark.createDataFrame([("alias.net", "/free", "bad.com", "/de/7")], "host string, path string, to_host string, to_path string")
    assert {r.page_id: r.verdict for r in url_filter.judge(pages, RULES, more).collect()}[10] == "block"
    assert url_filter.judge(pages.filter("false"), RULES).count() == 0
