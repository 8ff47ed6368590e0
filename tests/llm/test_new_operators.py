"""Hard negatives, repetition and divergence against brute force on small tables."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import texelframe.llm.queries as queries
from texelframe.llm import anchor_lists, divergence, repetition
from tests.llm.oracle import check_query

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", ["op11_shared_anchor_lists", "op12_repetition_coverage", "op13_source_divergence"])
def test_queries_give_what_their_sql_gives(spark, folder, name):
    check_query(spark, folder, queries.QUERIES[name], queries.ORACLES[name])


# --- hard negatives ---------------------------------------------------------------------

ROWS = "vec_id long, label int, vector array<long>, rank long, score long"


def brute_negatives(rows, is_anchor, positives=5, negatives=5, lowest=80):
    out = []
    whole = [r for r in rows if r[0] is not None and r[1] is not None and r[2] is not None and None not in r[2]]
    for a in filter(lambda r: is_anchor(r[0]), whole):
        score = lambda r: max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a[2], r[2]))))  # noqa: B023, E731
        others = sorted(((-score(r), r[0], r[1]) for r in whole if r[0] != a[0] and len(r[2]) == len(a[2])))
        for s, p, _ in [o for o in others if o[2] == a[1]][:positives]:
            fit = [o for o in others if o[2] != a[1] and lowest * -s <= 100 * -o[0] <= 100 * -s][:negatives]
            out += [(a[0], p, k + 1, o[1], -s, -o[0]) for k, o in enumerate(fit)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, 1) for r in rows], ROWS)
    got = anchor_lists.mine(df, F.col("vec_id") % 10 == 0, **options).collect()
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[c] for c in names) for r in got)


def clustered(rng, n, wide=6):
    centres = rng.normal(size=(5, 8)) * 60
    return [(k, int(rng.integers(0, wide)), np.floor(centres[rng.integers(0, 5)] + rng.normal(size=8) * 25).astype(int).tolist()) for k in range(n)]


def test_hard_negatives_with_small_chunks_groups_and_steps(spark, monkeypatch):
    for name, value in {"CHUNK": 40, "GROUP": 9, "MEMBERS": 3, "STEP": 4, "MAX_STEP": 16}.items():
        monkeypatch.setattr(anchor_lists, name, value)
    rows = clustered(np.random.default_rng(1), 300)
    assert mined(spark, rows) == brute_negatives(rows, lambda i: i % 10 == 0)
    assert mined(spark, rows, positives=2, negatives=7, lowest=50) == brute_negatives(rows, lambda i: i % 10 == 0, 2, 7, 50)


def test_hard_negatives_of_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = clustered(rng, 60, wide=3)
    rows += [(100, 1, [0] * 8), (101, 1, [0] * 8), (102, 2, [0] * 8)]  # zero vectors score 0 with all
    rows += [(110, None, [1] * 8), (None, 1, [1] * 8), (120, 1, None), (130, 1, [1, None, 1, 1, 1, 1, 1, 1])]
    rows += [(140, 1, [5, 6]), (141, 1, [4, 6]), (142, 2, [4, 6]), (143, 2, [3, 7]), (150, 0, []), (151, 0, []), (152, 1, [])]
    rows += [(160, 9, [40] * 8)]  # no positive
    rows += [(k, k % 2, [30, 30, 30, 30, 0, 0, 0, 0]) for k in range(200, 230)]  # ties
    big = 2**62
    rows += [(300, 4, [big, big, 3]), (301, 4, [big, 0, 1]), (302, 5, [big, 0, 0]), (303, 5, [big // 2, 1, 1]), (304, 5, [1, 1, 1])]
    rows += [(400, 4, [2**40, 7, 1, 1]), (401, 4, [2**40, 5, 0, 0]), (402, 5, [2**40, 4, 0, 0]), (403, 5, [2**40, 5, 0, 1])]
    assert mined(spark, rows) == brute_negatives(rows, lambda i: i % 10 == 0)


def test_hard_negatives_of_repeated_rows_and_empty_tables(spark):
    rows = clustered(np.random.default_rng(3), 40, wide=2)
    twice = rows + [r for r in rows if r[0] % 10 == 0] + rows[:7]
    assert mined(spark, twice) == brute_negatives(twice, lambda i: i % 10 == 0)
    assert mined(spark, []) == [] and mined(spark, [(1, 1, [1, 2])]) == [] and mined(spark, [(10, 1, [1, 2])]) == []


def test_walks_end_before_the_end_of_their_list():
    rng = np.random.default_rng(4)
    centres = np.eye(16)[:8] * 200
    x = np.floor(centres[np.repeat(np.arange(8), 1000)] + rng.normal(size=(8000, 16)) * 5).astype(np.int64)
    unit = anchor_lists._unit(x[:20].astype(float))[0]
    centroid = anchor_lists._unit(unit.sum(axis=0)[None])[0][0]
    entries = anchor_lists.SharedList(x, np.arange(8000), np.zeros(8000), centroid, np.arccos(unit @ centroid).max())
    read = []
    real = anchor_lists.products
    anchor_lists.products = lambda a, b: (read.append(len(b)), real(a, b))[1]
    try:
        bounds = np.full((20, 1), anchor_lists.LEAST), np.full((20, 1), 2**62)
        row, score, ids = anchor_lists.walk(entries, x[:20], np.arange(20), *bounds, 5)
    finally:
        anchor_lists.products = real
    s = x[:20] @ x.T
    s[np.arange(20), np.arange(20)] = -1
    assert (score.reshape(20, 5) == -np.sort(-s, axis=1)[:, :5]).all()
    assert sum(read) < 3000


# --- repetition -------------------------------------------------------------------------


def brute_repetition(text):
    text = text or ""
    words = WORD.findall(text)

    def under(n):
        grams = [tuple(words[k : k + n]) for k in range(len(words) - n + 1)]
        seen = Counter(grams)
        return {k + j for k, g in enumerate(grams) if seen[g] > 1 for j in range(n)}

    lines = Counter(line for line in text.split("\n") if WORD.search(line))
    chars = lambda ws: sum(map(len, ws))
    out = {
        "n_words": len(words), "word_chars": chars(words), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": sum(lines.values()) - len(lines), "n_repeat_words": len(under(3)), "n_lines": sum(lines.values()),
        "dup_line_chars": sum(chars(WORD.findall(line)) * (n - 1) for line, n in lines.items()),
        **{f"covered_{n}": chars(words[k] for k in under(n)) for n in repetition.COVERED},
    }
    out["base_failed"] = out["n_words"] < 50 or 100 * out["n_repeat_words"] > 50 * out["n_words"]
    out["kept"] = not out["base_failed"] and 100 * out["dup_line_chars"] <= 20 * out["word_chars"] and 100 * out["n_dup_lines"] <= 30 * out["n_lines"]
    out["kept"] &= all(100 * out[f"covered_{n}"] <= most * out["word_chars"] for n, most in repetition.COVERED.items())
    return out


def repetitive_texts():
    rng = np.random.default_rng(5)
    texts = ["", None, " \n\t ", "one", "a a a a", "a b a b a b", "x\n" * 30, "#*$%&|<> é€😀 #", "\n\n\nline\n\nline\r\nline\n", "word\x00word \x1f z"]
    for n in (48, 50, 200, 900):
        words = [f"w{k}é" if k % 3 else f"w{k}" for k in rng.integers(0, 10**6, n)]
        texts.append(" ".join(words))
        texts.append("  ".join(words) + "\n" + " ".join(words[: n // 3]))
        texts.append("\n".join(" ".join(words[k : k + 9]) for k in range(0, n, 6)))  # lines that overlap
        texts.append("\n".join([" ".join(words[k : k + 8]) for k in range(0, n, 8)] + [" ".join(words[:8])] * 4))
        texts.append(" ".join(f"w{k}" for k in rng.integers(0, 4, n)))
    texts.append("ab " * 100_000)
    texts.append(" ".join(f"u{k}" for k in range(200_000)))
    return texts


def test_repetition_is_that_of_each_text_alone(spark):
    texts = repetitive_texts()
    rows = [(k if k != 3 else None, t, "other", 1) for k, t in enumerate(texts)] + [(5, texts[5], "again", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int")
    got = repetition.measure(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute_repetition(texts[3 if r.doc_id is None else r.doc_id])
        assert {c: r[c] for c in want} == want, r.doc_id
    assert repetition.measure(docs.limit(0)).count() == 0


def test_rules_reject_copies_and_leave_plain_texts():
    rng = np.random.default_rng(6)
    plain = " ".join(f"w{k}" for k in rng.integers(0, 3000, 2000))
    kept = lambda t: bool(repetition.judge(repetition.measures(repetition.pa.array([t])))[1][0])
    assert kept(plain) and not kept(" ".join([plain] * 2)) and not kept(plain[:300] + "\n" + "\n".join(["the same line"] * 40))


# --- divergence -------------------------------------------------------------------------


def brute_audit(rows, min_docs=10):
    rows = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")) for text, lang, source in rows]
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    rows = [(lang, source, [*map(lower, terms)]) for lang, source, terms in rows]
    out = []
    for lang in {r[0] for r in rows}:
        held, in_lang, counts = Counter(), Counter(), defaultdict(Counter)
        for own, source, terms in rows:
            if own == lang:
                held.update(set(terms))
                counts[source].update(terms)
        kept = {t for t, n in held.items() if n >= min_docs}
        for c in counts.values():
            in_lang.update({t: n for t, n in c.items() if t in kept})
        total = {s: sum(n for t, n in c.items() if t in kept) for s, c in counts.items()}
        p = lambda n, all_: 1 + 10**9 * (n + 2) // (all_ + 2 * len(kept))  # noqa: E731, B023
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pairs = [(-sum(f(p(counts[s][t], total[s]), p(counts[o][t], total[o])) for t in kept), o) for o in counts if o != s]
            out += [(lang, s, "pair", o, -v, k) for k, (v, o) in enumerate(sorted(pairs, key=lambda x: (x[0], x[1].encode())), 1)]
            over = [(t, p(counts[s][t], total[s]), p(in_lang[t], sum(in_lang.values()))) for t in kept if counts[s][t]]
            terms = sorted(((-f(a, b), t) for t, a, b in over if a > b), key=lambda x: (x[0], x[1].encode()))[:10]
            out += [(lang, s, "term", t, -v, k) for k, (v, t) in enumerate(terms, 1)]
    return sorted(out)


def audited(spark, rows, **options):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "text string, lang string, source string, value long, term string")
    return sorted(tuple(r) for r in divergence.audit(df, **options).select("lang", "source", "part", "item", "value", "rank").collect())


def spoken(rng, n):
    vocabulary = [f"{a}{b}é" if k % 5 == 0 else f"{a}{b}" for k, (a, b) in enumerate((a, b) for a in "abcdefgh" for b in "klmnopQRS")]
    rows = []
    for _ in range(n):
        lang, source = ["en", "de", "fr"][rng.integers(0, 3)], f"s{rng.integers(0, 7)}"
        words = rng.choice(vocabulary, rng.integers(0, 40), p=None)
        rows.append((" ".join(w + ["", ",", "7", "-", "\x00", "\n"][rng.integers(0, 6)] + ["", "x"][rng.integers(0, 2)] for w in words), lang, source))
    return rows


def test_divergence_over_many_blocks_and_tiles(spark, monkeypatch):
    rows = spoken(np.random.default_rng(7), 300)
    want = brute_audit(rows, 4)
    assert audited(spark, rows, min_docs=4) == want
    assert {r[2] for r in want} == {"pair", "term"} and len({r[0] for r in want}) == 3
    monkeypatch.setattr(divergence, "BLOCK", 5)
    monkeypatch.setattr(divergence, "TILE", 3)
    # the driver lays out blocks and tiles
    assert audited(spark, rows, min_docs=4) == want


def test_divergence_of_odd_rows(spark):
    rows = [("same Words here é", "en", "b")] * 12 + [("same words", "en", None), (None, "en", "c"), ("", None, None), ("12 34", None, "z"), (None, None, None)]
    rows += [("alone " * 3, "xx", "only")] * 11 + [("few", "yy", "p"), ("terms", "yy", "q")] + [("word " * 50_000 + "é" * 10_000, "en", "long")]
    assert audited(spark, rows) == brute_audit(rows)
    assert audited(spark, []) == []


def test_trees_share_equal_subtrees_and_price_pairs_once():
    counts = np.zeros((3, 1000), dtype=np.int64)
    counts[0, ::7], counts[1, 500:503], counts[2] = 2, 5, counts[0]
    trees = divergence.Trees(counts)
    assert trees.roots[0] == trees.roots[2] != trees.roots[1]
    assert sum(c.shape[1] for c in trees.children) < 400  # of 3 * 1023 without sharing
    p = [divergence.shares(trees.leaves, int(c.sum()), 1000) for c in counts]
    plain = sum(int(divergence.differences(p[0][trees.leaves.searchsorted([x])], p[1][trees.leaves.searchsorted([y])])[0]) for x, y in zip(counts[0], counts[1]))
    assert trees.price(0, 1, p[0], p[1]) == plain and trees.price(0, 2, p[0], p[2]) == 0


def test_shares_of_huge_counts_are_exact():
    counts = np.array([0, 3, 10**15, 7 * 10**17], dtype=np.int64)
    assert divergence.shares(counts, 10**18, 5).tolist() == [1 + 10**9 * (int(c) + 2) // (10**18 + 10) for c in counts]
