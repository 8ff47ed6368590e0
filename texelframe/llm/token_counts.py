"""Token counts under a unigram model, by dynamic programming shared through a trie.

A pre-token is a white-space separated word with the vocabulary's word mark before it. Its tokens are
the split into pieces of the best sum of scores, of equal ones that with fewer pieces. The best
score of a prefix depends on the prefix only: distinct pre-tokens are put into a trie, each new
node is scored once from the nodes above it, and a pre-token's count is read at its
end. Pieces are those of a public vocabulary file, which lists them by rank; their scores are
log-probabilities by Zipf's law of that rank, so that no tokenizer is trained. A character that is no
piece costs one token for each of its UTF-8 bytes.

The tasks of a stage share a trie in each Python worker. At `MAX_NODES` it is started anew, and the counts of the pre-tokens of the last one are kept beside it,
which changes no result. A word of more than `LONG_WORD` characters isn't put into it: the scores of its last prefixes, as many as a
piece has characters, are enough. Nothing is shuffled.

Defined results: a null, empty or blank text has no word and no token; repeated rows are
counted each by themselves; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from texelframe.llm.common import Words, of_stage, release, slices

MAX_NODES = 400_000
UNKNOWN = 10.0  # a byte's score below that of the last piece
WORD_MARK = "▁"
LONG_WORD = 100


def load_scores(path: str) -> dict[str, float]:
    """Pieces of a sentencepiece file, scored by Zipf's law of their rank; control and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    total = math.log(math.fsum(1 / (k + 1) for k in range(len(ids))))
    return {model.id_to_piece(i): -math.log(k + 1) - total for k, i in enumerate(ids)}


class Trie:
    """Prefixes of the pre-tokens seen, each with the best score and token count of its split."""

    def __init__(self, scores: dict[str, float], max_nodes: int = MAX_NODES):
        self.scores, self.max_nodes = scores, max_nodes
        self.longest = max(map(len, scores), default=1)
        self.byte = min(scores.values(), default=0.0) - UNKNOWN
        self.older: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.next: dict[tuple[int, str], int] = {}
        self.best, self.tokens = [0.0], [0]
        self.ends: dict[str, int] = {}

    def count(self, word: str) -> int:
        """Tokens of a pre-token; the word mark is put before it."""
        found = self.ends.get(word)
        if found is None:
            found = self.older.get(word)
            if found is None:
                return self.insert(word) if len(word) <= LONG_WORD else self.count_long(word)
            self.ends[word] = found
        return found

    def count_long(self, word: str) -> int:
        """The count of `insert`, from the scores of the prefixes that a piece may reach back to."""
        text = WORD_MARK + word
        last = deque([(0.0, 0)], maxlen=self.longest)  # best score and tokens of the last prefixes
        for end, char in enumerate(text, 1):
            size = len(char.encode("utf-8", "surrogatepass"))
            top, n = last[-1][0] + size * self.byte, last[-1][1] + size
            first = end - len(last)
            for begin in range(first, end):
                score = self.scores.get(text[begin:end])
                if score is not None:
                    above, count = last[begin - first]
                    score += above
                    if score > top or (score == top and count + 1 < n):
                        top, n = score, count + 1
            last.append((top, n))
        return last[-1][1]

    def insert(self, word: str) -> int:
        if len(self.best) >= self.max_nodes or len(self.ends) >= self.max_nodes:
            self.older = self.ends
            self.clear()
        step, best, tokens, scores, longest = self.next, self.best, self.tokens, self.scores, self.longest
        text = WORD_MARK + word
        node, path = 0, [0]
        for end, char in enumerate(text, 1):
            key = (node, char)
            child = step.get(key)
            if child is None:
                size = len(char.encode("utf-8", "surrogatepass"))
                top, n = best[node] + size * self.byte, tokens[node] + size
                for begin in range(max(0, end - longest), end):
                    score = scores.get(text[begin:end])
                    if score is not None:
                        above = path[begin]
                        score += best[above]
                        if score > top or (score == top and tokens[above] + 1 < n):
                            top, n = score, tokens[above] + 1
                child = step[key] = len(best)
                best.append(top)
                tokens.append(n)
            node = child
            path.append(node)
        self.ends[word] = tokens[node]
        return tokens[node]


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_words, n_tokens) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = of_stage(vocabulary, lambda: Trie(load_scores(vocabulary)))
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"))
                counts = np.fromiter(map(trie.count, words.distinct.to_pylist()), dtype=np.int64, count=len(words.distinct))
                total = np.concatenate([[0], np.cumsum(counts[words.codes])])[words.ends]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(words.counts.astype(np.int64)), pa.array(np.diff(total, prepend=0))], names=["doc_id", "n_words", "n_tokens"]
                )
        release()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_tokens long")
