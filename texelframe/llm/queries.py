"""Registered queries of the operators in this subpackage, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from texelframe.llm import (
    anchor_lists, divergence, huffman, lattice_dedup, mixing, ngram_join, packing, quality, repetition, token_counts, toxicity, url_filter,
    vector_tree,
)
from texelframe.llm.common import crc_mod, stored, table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.Model:
    """Learnt from the documents whose id's check sum modulo 3 isn't 1."""
    return quality.fit(docs, labels.filter(crc_mod(F.col("doc_id"), 3) != 1).select("doc_id", F.col("quality").alias("label")))


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Learnt from the documents whose id's check sum modulo 4 isn't 2."""
    return toxicity.fit(docs, labels.filter(crc_mod(F.col("doc_id"), 4) != 2).select("doc_id", F.col("toxic").alias("label")))


def op1_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality_model(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


def op8_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")


def op2_url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url, by rules or by its aliases."""
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES)


def op3_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and unigram tokens of every whole text."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), PIECES)


def op4_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, coded into the stored format and read back."""
    docs = table(spark, sf_dir, "documents")
    blocks, codes = huffman.write_blocks(stored(huffman.token_rows(docs, WORD_BPE, end_id=1)))
    return huffman.read_blocks(blocks, codes, digest=True)


def op5_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all vectors: cosine of 0.9 or more."""
    return lattice_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of whole texts: five-word shingles, similarity of 0.8 or more."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), percent=80)


def op7_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op9_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every whole text in sequences of 4096 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), WORD_BPE, end_id=2, window=4096)


def op10_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all vectors, by inner product, of each vector whose id is divisible by 20."""
    return vector_tree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, n=20)


def op11_shared_anchor_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of each vector whose id is divisible by 100, among all vectors in steps of 1/256."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    steps = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), F.when(finite, steps).alias("vector"))
    return anchor_lists.mine(rows, F.col("vec_id") % 100 == 0, positives=5, negatives=5, lowest=80)


def op12_repetition_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition within every whole text, and the verdict of the rules on it."""
    return repetition.measure(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of the sources of each language, and the terms most in excess."""
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_crf_quality,
        op2_url_aliases,
        op3_trie_token_counts,
        op4_huffman_ids,
        op5_lattice_dedup,
        op6_ngram_jaccard,
        op7_pivotal_mix,
        op8_weak_toxicity,
        op9_sum_of_squares_packing,
        op10_kmeans_tree,
        op11_shared_anchor_lists,
        op12_repetition_coverage,
        op13_source_divergence,
    )
}

def _repetition_sql() -> str:
    """The words of all texts with the number of copies of the windows that begin there, then what they cover."""
    lengths = (repetition.REPEAT_WINDOW, *repetition.COVERED)
    ahead = lambda n: ", ' ', ".join(["w", *(f"lead(w, {k}) OVER o" for k in range(1, n))])
    grams = ", ".join(f"CASE WHEN lead(w, {n - 1}) OVER o IS NOT NULL THEN concat({ahead(n)}) END AS g{n}" for n in lengths)
    twice = ", ".join(f"g{n} IS NOT NULL AND count(*) OVER (PARTITION BY row, g{n}) > 1 AS d{n}" for n in lengths)
    under = ", ".join(f"bool_or(d{n}) OVER (PARTITION BY row ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS c{n}" for n in lengths)
    sums = ", ".join(f"coalesce(sum(length(w)) FILTER (c{n}), 0) AS covered_{n}" for n in repetition.COVERED)
    names = ", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in repetition.COUNTS)
    too_much = " OR ".join(f"100 * covered_{n} > {most} * word_chars" for n, most in repetition.COVERED.items())
    return rf"""
        WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
        words AS (SELECT row, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
                  FROM (SELECT row, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d)),
        grams AS (SELECT row, i, w, {grams} FROM words WINDOW o AS (PARTITION BY row ORDER BY i)),
        twice AS (SELECT row, i, w, {twice} FROM grams),
        under AS (SELECT row, i, w, {under} FROM twice),
        by_words AS (SELECT row, count(*) AS n_words, sum(length(w)) AS word_chars, count(*) FILTER (c{repetition.REPEAT_WINDOW}) AS n_repeat_words, {sums}
                     FROM under GROUP BY row),
        lines AS (SELECT row, line, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars, count(*) AS n
                  FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM d)
                  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row, line),
        by_lines AS (SELECT row, sum(n) AS n_lines, sum(n - 1) AS n_dup_lines, sum(chars * (n - 1)) AS dup_line_chars FROM lines GROUP BY row),
        counts AS (SELECT doc_id, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, by_words.*, n_lines, n_dup_lines, dup_line_chars
                   FROM d LEFT JOIN by_words USING (row) LEFT JOIN by_lines USING (row)),
        filled AS (SELECT doc_id, {names} FROM counts),
        judged AS (SELECT *, n_words < {repetition.MIN_WORDS} OR 100 * n_repeat_words > {repetition.MAX_REPEAT_WORDS} * n_words AS base_failed,
                          100 * dup_line_chars > {repetition.LINE_CHARS} * word_chars OR 100 * n_dup_lines > {repetition.LINES} * n_lines OR {too_much} AS too_much
                   FROM filled)
        SELECT * EXCLUDE too_much, NOT base_failed AND NOT too_much AS kept FROM judged
    """


# The others learn, tokenize, hash or round at random; tests hold them against brute force.
ORACLES = {
    "op2_url_aliases": r"""
        WITH RECURSIVE parts AS (
            SELECT page_id, html,
                   translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
            FROM pages),
        rules(said, h, p) AS (
            VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
        ruled AS (
            SELECT page_id, host, path, html,
                   (SELECT max_by(h || p, length(h || p)) FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule,
                   (SELECT max_by(said, length(h || p)) FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS own
            FROM parts),
        targets AS (
            SELECT host || path AS a,
                   CASE WHEN regexp_matches(tag, '^<link\s.*\brel\s*=\s*["'']?canonical\b', 'is') THEN regexp_extract(tag, '\bhref\s*=\s*["'']?([^"''\s>]+)', 1, 'is')
                        WHEN regexp_matches(tag, '^<meta\s.*\bhttp-equiv\s*=\s*["'']?refresh\b', 'is') THEN regexp_extract(tag, '\burl\s*=\s*["'']?([^"''\s>]+)', 1, 'is') END AS url
            FROM (SELECT host, path, unnest(regexp_extract_all(html, '<(?:link|meta)\s[^>]*>', 0, 'is')) AS tag FROM parts)),
        edges AS (
            SELECT a, lower(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's')) || regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS b
            FROM targets WHERE url LIKE '%://%'),
        both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
        reached(node) AS (
            SELECT node FROM (SELECT a AS node FROM both_ways)
            WHERE (SELECT max_by(said, length(h || p)) FROM rules
                   WHERE (regexp_extract(node, '^[^/]*') = h OR ends_with(regexp_extract(node, '^[^/]*'), '.' || h)) AND starts_with(regexp_extract(node, '/.*$'), p)) = 'block'
            UNION
            SELECT b FROM reached JOIN both_ways ON a = node)
        SELECT page_id, host, path, rule,
               CASE WHEN own IS NOT NULL THEN own WHEN host || path IN (SELECT node FROM reached) THEN 'block' ELSE 'allow' END AS verdict
        FROM ruled
    """,
    "op11_shared_anchor_lists": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        scores AS (
            SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, positive_id,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives p JOIN scores s
          ON p.anchor_id = s.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
        QUALIFY rank <= 5
    """,
    "op12_repetition_coverage": _repetition_sql(),
    "op13_source_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        words AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
        q AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
        langs AS (SELECT lang, sum(n) AS total, count(*) AS v FROM q GROUP BY lang),
        found AS (SELECT w.lang, source, w.term, count(*) AS n FROM words w JOIN q ON w.lang = q.lang AND w.term = q.term GROUP BY ALL),
        groups AS (SELECT lang, source, coalesce((SELECT sum(n) FROM found f WHERE f.lang = g.lang AND f.source = g.source), 0) AS total
                   FROM (SELECT DISTINCT lang, source FROM d) g),
        p AS (
            SELECT g.lang, g.source, q.term, coalesce(f.n, 0) AS n, 1 + (1000000000 * (coalesce(f.n, 0) + 2)) // (g.total + 2 * l.v) AS p,
                   1 + (1000000000 * (q.n + 2)) // (l.total + 2 * l.v) AS q
            FROM groups g JOIN langs l ON g.lang = l.lang JOIN q ON g.lang = q.lang
            LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = q.term),
        pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
            UNION ALL
            SELECT a.lang, a.source, 'pair', b.source, 0 FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            WHERE a.lang NOT IN (SELECT lang FROM langs)),
        terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
               CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
        FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
        QUALIFY part = 'pair' OR rank <= 10
    """,
}
