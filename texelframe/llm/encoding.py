"""Token ids of whole texts by the tokenizers library, many texts at a time.

The tokenizer file drops white space and splits the rest into pre-tokens, so that a text's
ids are those of its pre-tokens in turn. Distinct pre-tokens of a batch are encoded once
and kept in a cache of at most `CACHED_BYTES`, which the tasks of a stage share in a Python worker and which goes with
the stage; ids of texts are gathered from them.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from texelframe.llm.common import Memo, Words, ranges

CACHED_BYTES = 160_000_000

# The tokenizer file's pre-tokens (but for runs of letters, which remain) and
# the end mark of its pieces.
MARKS = r"('[sS]|'[tT]|'[rR][eE]|'[vV][eE]|'[mM]|'[lL][lL]|'[dD]|\p{N}|[^\x09-\x0D\x20\p{L}\p{N}]+)"
WORD_END = "</w>"

# Texts of these characters are split and lower-cased by Arrow: they hold no combining mark,
# no other white space, and lower-case one to one. Others go to the library word by word.
PLAIN = r"^[\x09-\x0D\x20-\x7E\x{A1}-\x{AC}\x{AE}-\x{12F}\x{132}-\x{24F}]*$"

class Encoder:
    """Encodes texts with a word-end BPE tokenizer file, without special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.pieces = Tokenizer(self.whole.model)
        self.pieces.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.last = np.zeros(self.whole.get_vocab_size() + 1, dtype=bool)
        for token, i in self.whole.get_vocab().items():
            self.last[i] = token.endswith(WORD_END)
        self.plain, self.odd = Memo(CACHED_BYTES), Memo(CACHED_BYTES // 8)

    def _plain(self, new: list[str]) -> list[bytes]:
        """Ids, as bytes, of pre-tokens in lower case."""
        out = []
        for k in range(0, len(new), 256):
            part = new[k : k + 256]
            ids = np.array(self.pieces.encode(" ".join(part), add_special_tokens=False).ids, dtype=np.uint16)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):
                raw, ends = ids.tobytes(), [0, *(ends * 2).tolist()]
                out += [raw[a:b] for a, b in zip(ends, ends[1:])]
            else:  # a piece that looks like a word's end inside a word
                out += [np.array(x.ids, dtype=np.uint16).tobytes() for x in self.pieces.encode_batch_fast(part, add_special_tokens=False)]
        return out

    def _odd(self, new: list[str]) -> list[bytes]:
        return [np.array(x.ids, dtype=np.uint16).tobytes() for x in self.whole.encode_batch_fast(new, add_special_tokens=False)]

    def _gather(self, texts: pa.Array, memo: Memo, encode) -> tuple[np.ndarray, np.ndarray]:
        words = Words(texts)
        distinct = words.distinct.to_pylist()
        ids, missing = memo.find(distinct)
        if missing:
            new = [distinct[k] for k in missing]
            made = encode(new)
            for k, x in zip(missing, made):
                ids[k] = x
            memo.keep(dict(zip(new, made)))
        counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 2
        pool = np.frombuffer(b"".join(ids), dtype=np.uint16)
        per_word = counts[words.codes]
        tokens = pool[ranges((np.cumsum(counts) - counts)[words.codes], per_word)]
        return tokens, np.concatenate([[0], np.cumsum(per_word)])[words.ends]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another (uint16), and for each text the number of ids up to its end.

        A null text counts as empty.
        """
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        plain = pc.and_not(pc.match_substring_regex(texts, PLAIN), pc.match_substring(texts, "<|"))
        marked = pc.utf8_lower(pc.replace_substring_regex(texts.filter(plain), MARKS, r" \1 "))
        tokens, ends = self._gather(marked, self.plain, self._plain)
        plain = plain.to_numpy(zero_copy_only=False)
        if plain.all():
            return tokens, ends
        more, more_ends = self._gather(texts.filter(pa.array(~plain)), self.odd, self._odd)
        counts, starts = np.empty(len(texts), dtype=np.int64), np.empty(len(texts), dtype=np.int64)
        for rows, e, before in ((plain, ends, 0), (~plain, more_ends, len(tokens))):
            counts[rows] = np.diff(e, prepend=0)
            starts[rows] = before + e - counts[rows]
        return np.concatenate([tokens, more])[ranges(starts, counts)], np.cumsum(counts)


def with_end(tokens: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids (uint16) with end_id after each text's, and the new ends."""
    out = np.insert(tokens, ends, np.uint16(end_id))
    return out, ends + np.arange(1, len(ends) + 1)
