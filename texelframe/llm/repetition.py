"""Quality rules on repetition: the share of a text's characters inside duplicated n-grams and lines.

Words are numbered within a slice of texts, and the numbers' mixed bits are rolled into one hash per
window of n words, for several n from short to long: the hash of n words and the next word's give that of n + 1.
A window is duplicated when its text holds an equal one, found by sorting hashes together with
the text's own. A window of n words can be duplicated only where the shorter one at its start
is, so that each length looks at what the one before it has left. The words under duplicated windows, the first copy
included, count once however many windows cover them. A line counts when an earlier line of its
text equals it.

A document is kept when it has enough words, when not too many of them stand in duplicated windows of three words (the
base rules), and when no share of characters exceeds its limit (`COVERED`, `LINE_CHARS`, `LINES`).

Everything is one pass over the texts, without a shuffle. A task holds a slice of texts, or one text where that is
longer, and about 30 times its size in numbers.

Defined results: a null text is an empty one, with zeros, which fails for its words; repeated rows and ids are judged
each by themselves; a null doc_id is returned as it is; an empty table gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from texelframe.llm.common import Words, release, slices

MIN_WORDS = 50
REPEAT_WINDOW = 3
MAX_REPEAT_WORDS = 50  # percent of words in duplicated windows of three

# Percent of the characters of all words that may be inside duplicated n-grams, by n: twice the limits that are usual
# for web text where only later copies count, for the first copy counts here as well.
COVERED = {5: 30, 6: 28, 7: 26, 8: 24, 9: 22, 10: 20}
LINE_CHARS = 20  # percent of the characters of all words that may be in lines equal to an earlier one
LINES = 30  # percent of lines with a word that may equal an earlier one

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(n: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    n = (n.astype(np.uint64) + np.uint64(1)) * _ODD
    n = (n ^ (n >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return n ^ (n >> np.uint64(32))


def duplicated_windows(words: Words, lengths: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray]]:
    """For each length, shortest first, the places in `words` where a window that its text holds twice or more begins."""
    of_word = _mixed(np.arange(len(words.distinct)))
    row = words.rows()
    of_text = _mixed(row + len(of_word))
    end = words.ends[row]  # of the word's text
    at = np.arange(len(words.codes))
    rolled, done = np.zeros(len(at), dtype=np.uint64), 0
    for n in sorted(lengths):
        fits = at + n <= end[at]
        at, rolled = at[fits], rolled[fits]
        for k in range(done, n):
            rolled = rolled * _ODD + of_word[words.codes[at + k]]
        done = n
        key = _mixed(rolled ^ of_text[at])
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        at, rolled = at[twice], rolled[twice]
        yield n, at


def covered(at: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of `total` words stand in one of the windows of n words that begin at `at`."""
    edges = np.bincount(at, minlength=total + 1) - np.bincount(at + n, minlength=total + 1)
    return np.cumsum(edges)[:total] > 0


def line_repeats(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text: lines with a word, those of them that equal an earlier line, and the characters of words in these."""
    parts = pc.split_pattern(texts, "\n")
    offsets = parts.offsets.to_numpy().astype(np.int64)
    lines = parts.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    doc = np.repeat(np.arange(len(parts)), np.diff(offsets))
    full = pc.match_substring_regex(lines, r"[^\x20\x09-\x0D]")
    lines, doc = lines.filter(full), doc[full.to_numpy(zero_copy_only=False)]
    n_lines = np.bincount(doc, minlength=len(parts))
    if not len(lines):
        return n_lines, np.zeros_like(n_lines), np.zeros_like(n_lines)
    code = pc.dictionary_encode(lines).indices.to_numpy(zero_copy_only=False).astype(np.int64)
    key = doc * (int(code.max()) + 1) + code
    first = np.zeros(len(key), dtype=bool)
    first[np.unique(key, return_index=True)[1]] = True
    again = lines.filter(pa.array(~first))
    chars = pc.subtract(pc.utf8_length(again).cast(pa.int64()), pc.count_substring_regex(again, r"[\x20\x09-\x0D]").cast(pa.int64()))
    n_dup = np.bincount(doc[~first], minlength=len(parts))
    in_dup = np.bincount(doc[~first], weights=chars.to_numpy(zero_copy_only=False), minlength=len(parts))
    return n_lines, n_dup, in_dup.astype(np.int64)


def measures(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of `measure`, a number per text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    words = Words(texts)
    total = len(words.codes)
    chars = pc.utf8_length(words.distinct).to_numpy(zero_copy_only=False).astype(np.int64)[words.codes]

    def per_text(values: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(values)])[words.ends], prepend=0).astype(np.int64)

    n_lines, n_dup, in_dup = line_repeats(texts)
    out = {
        "n_words": words.counts.astype(np.int64),
        "word_chars": per_text(chars),
        "n_symbols": pc.count_substring_regex(texts, r"[#*$%&|<>]").to_numpy(zero_copy_only=False).astype(np.int64),
        "n_dup_lines": n_dup,
        "n_repeat_words": np.zeros(len(texts), dtype=np.int64),
        "n_lines": n_lines,
        "dup_line_chars": in_dup,
    }
    for n, at in duplicated_windows(words, (REPEAT_WINDOW, *COVERED)):
        under = covered(at, n, total)
        if n == REPEAT_WINDOW:
            out["n_repeat_words"] = per_text(under)
        else:
            out[f"covered_{n}"] = per_text(np.where(under, chars, 0))
    return out


def judge(m: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept) of texts of these measures."""
    base_failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_WORDS * m["n_words"])
    too_much = (100 * m["dup_line_chars"] > LINE_CHARS * m["word_chars"]) | (100 * m["n_dup_lines"] > LINES * m["n_lines"])
    for n, most in COVERED.items():
        too_much |= 100 * m[f"covered_{n}"] > most * m["word_chars"]
    return base_failed, ~base_failed & ~too_much


COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "dup_line_chars",
    *(f"covered_{n}" for n in COVERED),
)


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, counts, base_failed, kept) of every whole text.

    n_lines are lines with a word, dup_line_chars the characters of words in lines equal to an earlier one,
    covered_n those in duplicated windows of n words.
    """
    names = ["doc_id", *COUNTS, "base_failed", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = measures(part.column("text"))
                base_failed, kept = judge(found)
                columns = [pa.array(found[c], pa.int64()) for c in COUNTS]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), *columns, pa.array(base_failed), pa.array(kept)], names=names)
        release()

    schema = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), "base_failed boolean", "kept boolean"])
    return docs.select("doc_id", "text").mapInArrow(run, schema)
